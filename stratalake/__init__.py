"""Spec-driven layered analytics (bronze / silver / gold) on Spark DataFrames."""
