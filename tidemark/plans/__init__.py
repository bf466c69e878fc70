"""Registered queries: the operators applied to the test tables, each with its oracle SQL."""
