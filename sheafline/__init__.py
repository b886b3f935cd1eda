"""Spark-native analytics over extracted documents: text, tables, checks and corpora."""
