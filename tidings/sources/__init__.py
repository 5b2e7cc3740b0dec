"""Readers of feeds, channel messages and alert snapshots, and table sinks."""
