"""Composite reports (Q1–Q8), the query registry and its DuckDB oracle."""
