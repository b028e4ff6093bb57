"""DuckDB statements the Spark queries are checked against."""
