"""Relational building blocks of a mirror run."""
