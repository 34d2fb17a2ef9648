"""Sinks: overwrite, append, month-partition reload and upsert of result tables."""
