"""Subscription analytics on Spark: raw files to star schema, metrics and quality gate."""
