"""Readers and writers: files, budget sheets, entity models, databases, lake tables."""
