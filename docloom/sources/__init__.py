"""Readers, connectors and writers with explicit schemas."""
