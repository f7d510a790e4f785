"""Queries over the supplied tables: derived warehouse inputs, the queries, and the SQL they are checked against."""
