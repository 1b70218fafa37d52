"""Spark ML: features, profit regression, clustering and projection."""
