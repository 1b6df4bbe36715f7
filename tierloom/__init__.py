"""Layered (bronze, silver, gold) data work on Spark DataFrames."""
