"""Reusable DataFrame steps: filters, lookups and first-row-per-group picks."""
