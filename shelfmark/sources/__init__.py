"""Readers and writers: JSON files, database tables, derived tables."""
