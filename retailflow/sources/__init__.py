"""Readers of logs, change rows and dimensions."""
