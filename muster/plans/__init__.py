"""Census queries as declarative SQL over derived views; one text for Spark and for DuckDB."""
