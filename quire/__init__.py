"""Quire: a Spark-native engine for the text of scanned documents."""
