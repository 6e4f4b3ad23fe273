"""Sources and sinks: the versioned Parquet cell store and delimited text."""
