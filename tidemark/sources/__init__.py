"""Readers: clickstream CSV, ticket collections, exported model tables."""
