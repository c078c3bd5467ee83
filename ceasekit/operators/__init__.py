"""Reusable relational building blocks (DataFrame in, DataFrame out)."""
