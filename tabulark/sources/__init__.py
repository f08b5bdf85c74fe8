"""Scans, sinks, bookmarks and source adapters."""
