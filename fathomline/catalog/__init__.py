"""Registered queries, one module per area, each with its check SQL."""
