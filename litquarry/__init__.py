"""litquarry: a PySpark-native engine for literature-style corpora."""
