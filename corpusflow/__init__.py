"""corpusflow: a PySpark-native engine for curating large speech and text corpora."""
