"""fernlight: a PySpark-native engine for short social-style posts and text corpora."""
