"""A PySpark-native engine that integrates journal rankings into one canonical dimension."""
