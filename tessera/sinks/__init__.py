"""Appliers of plans to tables and file trees."""
