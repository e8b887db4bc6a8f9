"""tablestream: DataFrame-to-DataFrame functions for batch and streaming analytics on Spark."""
