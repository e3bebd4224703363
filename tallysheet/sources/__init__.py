"""Readers and extraction queries that fill the raw layer."""
