"""DataFrame operators: deduplication, preparation, upsert, ledger, checks."""
