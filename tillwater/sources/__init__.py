"""Readers and writers: CSV, layer tables and the files they live in."""
