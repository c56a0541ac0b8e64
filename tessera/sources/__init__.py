"""Scans, sinks and the derived test tables (fixtures F1–F11)."""
