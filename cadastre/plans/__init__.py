"""Whole flows, views onto the sample tables, and the registered queries."""
