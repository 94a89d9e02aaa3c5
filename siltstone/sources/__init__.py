"""Readers of captured responses, pages, notes and state files."""
