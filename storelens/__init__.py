"""Retail operations analytics on Spark: views, business queries, marts, checks and measures."""
