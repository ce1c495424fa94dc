"""Composed queries: marts, survey load jobs, source linking."""
