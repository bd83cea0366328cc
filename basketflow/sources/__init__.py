"""Zones, readers, writers and SQL access."""
