"""DataFrame operators: classification, extraction, table building, enrichment, updates, search, audits."""
