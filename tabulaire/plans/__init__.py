"""Aggregation plans: how statistics are computed over narrow and wide tables."""
