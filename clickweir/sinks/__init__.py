"""Writers: partitioned Parquet, managed tables, raw dump files."""
