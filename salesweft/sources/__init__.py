"""Readers, writers, declared schemas and the star-schema mapping."""
