"""Registered queries: each pairs a Spark plan with an equivalent SQL text."""
