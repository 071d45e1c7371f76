"""Chunk tables, file objects, copies, and run results."""
