"""Registered queries: a Spark callable per operator and, where SQL can say it, the same result as DuckDB text."""
