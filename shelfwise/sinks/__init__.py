"""Sinks: Parquet/CSV dataset writes, warehouse (catalog) and JDBC loads."""
