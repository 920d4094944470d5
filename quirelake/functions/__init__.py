"""Quirelake functions."""
