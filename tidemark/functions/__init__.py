"""Reusable column expressions and small DataFrame building blocks."""
