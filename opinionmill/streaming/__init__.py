"""Streaming forms of scoring and counting."""
