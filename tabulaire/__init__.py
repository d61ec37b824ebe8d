"""Preparation of sample-by-feature tables on Spark: scaling, normalising, filtering, design matrices."""
