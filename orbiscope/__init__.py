"""Spark-native analytics for sequences of panoramic frames and their masks."""
