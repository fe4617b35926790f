"""Queries over the benchmark tables, each with the SQL it must agree with."""
