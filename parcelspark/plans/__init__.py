"""Finished report jobs. Each takes a mapping of table name to DataFrame and an explicit ``as_of``."""
