"""lexloom: a PySpark-native engine for text corpora and lexicons."""

__version__ = "0.1.0"
