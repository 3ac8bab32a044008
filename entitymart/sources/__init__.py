"""Dumps, staged tables, snapshots, and the feed that renders relational tables as dump lines."""
