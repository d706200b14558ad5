"""PySpark-native curation and analysis of control-code and text corpora."""
