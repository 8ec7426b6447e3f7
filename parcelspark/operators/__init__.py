"""DataFrame operators: record picks, enrichment joins and roll-ups."""
