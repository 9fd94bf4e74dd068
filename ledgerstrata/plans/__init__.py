"""Batch runs, analytic queries and dashboard frames on the gold tables."""
