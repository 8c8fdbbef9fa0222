"""Spark-native lakehouse analytics: reusable operators, DataFrame in and DataFrame out."""
