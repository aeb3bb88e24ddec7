"""Streaming forms of the operators that a feed would otherwise be polled for."""
