"""Test data: the given tables seen as company filings, their stored layers, and checks."""
