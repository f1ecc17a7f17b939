"""Registered queries: each pairs an operator call with SQL that states the same result."""
