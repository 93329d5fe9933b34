"""Relations, keyed checks, version classification, reconciliation, repair and validation."""
