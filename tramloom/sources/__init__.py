"""Readers of snapshots, observations and static tables, writers of results, views over general tables."""
