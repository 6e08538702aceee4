"""Schemas, stores, readers and writers."""
