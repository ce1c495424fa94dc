"""Incremental processing of newly registered sources."""
