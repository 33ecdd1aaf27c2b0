"""Spark-native e-commerce analytics: bronze, silver and gold zones, data
quality, sales reports, segmentation, scoring and scaling reports."""
