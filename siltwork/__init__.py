"""A PySpark-native engine for curating, searching and checking question and text corpora."""
