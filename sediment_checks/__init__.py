"""Registered queries over snapshots derived from the given tables, and the same in plain SQL."""
