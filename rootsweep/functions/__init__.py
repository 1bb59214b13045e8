"""Column-level helpers: list membership, row fingerprints, error text."""
