"""Scalar functions as SQL expressions that Spark and DuckDB both read (dialect pieces in ``dialect``), and Column forms."""
