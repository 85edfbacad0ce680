"""Snapshot-based change capture and event-state analytics on Spark DataFrames."""
