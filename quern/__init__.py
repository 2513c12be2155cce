"""Quern: a Spark-native engine for text tables, document structure and corpora."""
