"""Retail invoice warehouse on PySpark: clean, derive, star schema, reports."""
