"""Quirelake sinks."""
