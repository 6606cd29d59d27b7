"""Scans: event streams, change events, relational tables, files and generated rows."""
