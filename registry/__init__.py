"""Registered queries with their DuckDB counterparts, and the stand-in tables both run on."""
