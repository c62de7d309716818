"""Input relations (catalog tables, parquet folders, test-table adapters) and output sinks."""
