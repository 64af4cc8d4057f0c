"""Catalogue and record-quality operators for Spark DataFrames."""
