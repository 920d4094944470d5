"""Quirelake sources."""
