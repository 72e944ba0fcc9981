"""Operators over planes, pixels, objects and tracks."""
