"""Registered queries, end-to-end loads, models, test-data adapters and oracle SQL."""
