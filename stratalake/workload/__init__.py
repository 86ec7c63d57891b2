"""The query catalogue over the given tables, and the SQL each query is checked against."""
