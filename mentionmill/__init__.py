"""Spark-native literature mining and co-association engine."""
