"""Registered queries: one or more per operator, over the given tables."""
