"""Registered queries, their inputs derived from the test tables, and oracle SQL."""
