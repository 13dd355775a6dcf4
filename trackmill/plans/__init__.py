"""Registered queries: the operators applied to the benchmark tables."""
