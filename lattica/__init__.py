"""Lattica: a PySpark-native engine for graphs of annotated, nested records."""
