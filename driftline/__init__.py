"""Diagnosis of recorded multi-step runs with Spark DataFrames and streams."""
