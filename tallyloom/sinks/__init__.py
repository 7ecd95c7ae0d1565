"""Keyed loads, snapshots, load statistics and file writers."""
