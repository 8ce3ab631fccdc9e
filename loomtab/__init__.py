"""Dataset-level analytics for tabular and panel data, as Spark DataFrame operations."""
