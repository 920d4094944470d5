"""Quirelake streaming."""
