"""Test rule corpus and DuckDB oracle SQL used by the checks."""
