"""Revision-text analytics on Spark DataFrames."""
