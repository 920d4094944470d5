"""Quirelake operators."""
