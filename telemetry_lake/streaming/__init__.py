"""Structured Streaming counterparts; stateless steps reuse the batch functions as they are."""
