"""Composed jobs: star schema, reports, the full batch."""
