"""Source registry, delivered files, raw tables and ledger tables."""
