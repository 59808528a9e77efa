"""Spark-native genomics analytics: declarative DataFrame operators and query plans."""
