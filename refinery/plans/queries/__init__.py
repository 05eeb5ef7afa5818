"""Registered queries: every operator and entity over the given tables, with its oracle SQL."""
