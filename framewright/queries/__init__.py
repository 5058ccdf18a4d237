"""Queries over the test tables, with their SQL: each module has QUERIES and SQL."""
