"""Schemas, readers, writers, and the mapping of trade tables to a star schema."""
