"""Sources: driver tables, role views over them, and Parquet sinks."""
