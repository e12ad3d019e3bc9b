"""Spark-native operators for harmonising many differently shaped datasets."""
