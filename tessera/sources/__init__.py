"""Readers of snapshots."""
