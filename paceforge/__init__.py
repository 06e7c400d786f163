"""Activity and recovery analytics as PySpark DataFrame functions."""
