"""Writers: versioned snapshots and chunked sorted Parquet."""
