"""Scans: parquet tables, flat files, storage listings, JDBC options."""
