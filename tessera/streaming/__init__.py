"""Mirroring driven by a stream of changed groups."""
