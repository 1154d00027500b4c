"""Batch operators: every one is ``f(df, ...) -> df``."""
