"""siltstone: a Spark-native engine for curating, searching and splitting text and code corpora."""

__version__ = "0.1.0"
