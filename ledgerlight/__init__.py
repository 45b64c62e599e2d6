"""Sales analytics on Spark: sources, marts, indicators, sinks and streams."""
