"""Incremental conversion, cursors, run logs and refresh checks."""
