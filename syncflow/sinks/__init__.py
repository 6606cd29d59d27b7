"""Targets: append-only day tables, keyed mirrors, files, topics and fan-out."""
