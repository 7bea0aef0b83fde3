"""Incident analytics on Spark: raw tickets to star schema, marts and models."""
