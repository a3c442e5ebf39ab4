"""Readers and writers: files, message topics, relational tables."""
