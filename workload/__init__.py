"""Registered queries: inputs shaped from the given tables, the Spark query, and SQL to check it."""
