"""Readers and writers: image planes, measurement tables, configurations and model bundles."""
