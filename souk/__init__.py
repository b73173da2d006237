"""Marketplace order analytics as Spark DataFrames."""
