"""Operators on text that a training corpus needs. Nothing outside this subpackage imports it."""
