"""Change-data engine on PySpark: versioned logs, state views, streaming ingest, reconciliation."""
