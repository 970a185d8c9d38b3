"""Arrivals warehouse on Spark: staging, lookups, visits fact, checks and rankings."""
