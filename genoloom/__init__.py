"""Spark-native variant annotation, scoring and prioritisation over whole cohorts."""
