"""Quirelake plans."""
