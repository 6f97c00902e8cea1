"""A Spark-native engine for ordered document blocks."""
