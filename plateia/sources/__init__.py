"""Readers and writers: landed JSON, settings, run tables."""
