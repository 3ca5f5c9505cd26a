"""Snapshot-building operators (SURVEY B-F): spine, timeline, snapshot."""
