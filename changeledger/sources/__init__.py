"""Tracked tables, connectors and change feeds."""
