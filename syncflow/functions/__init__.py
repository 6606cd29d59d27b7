"""Column-level building blocks: time handling, type mapping, text classification."""
