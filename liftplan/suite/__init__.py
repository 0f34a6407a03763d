"""Registered queries with their SQL counterparts, and the tables they derive."""
