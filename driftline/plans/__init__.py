"""Whole flows built from the operators, and the registered queries with their SQL."""
