"""Composite plans: demo queries, training bundle, run reports."""
