"""Structured Streaming: watermarks, tumbling windows, stateful suppression and sink drivers."""
