"""Whole runs, providers, derived input views and the query registry."""
