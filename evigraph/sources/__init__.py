"""Readers, adapters and writers."""
