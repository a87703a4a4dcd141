"""Result sinks: parquet folder, catalog table, JDBC."""
