"""Spark-native analytics for gridded, point-cloud and scene-network data."""
