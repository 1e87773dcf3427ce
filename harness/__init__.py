"""Wiring of the library to the given test tables: adapters, registered queries, check SQL."""
