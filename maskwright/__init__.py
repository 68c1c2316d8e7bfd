"""Spark-native detection, masking and audit of personal data in text tables."""
