"""Spark operators for cloud file-store inventories, migration plans and reconciliation."""
