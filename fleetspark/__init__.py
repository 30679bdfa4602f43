"""Batch fleet analytics written for Spark: every step is ``f(df, ...) -> DataFrame``."""
