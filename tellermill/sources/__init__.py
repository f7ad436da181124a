"""Readers and writers: delimited text, Parquet, JDBC, catalog, stand-in tables."""
