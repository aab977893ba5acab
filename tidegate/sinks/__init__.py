"""Writes: text, compressed text, partitioned and idempotent outputs."""
