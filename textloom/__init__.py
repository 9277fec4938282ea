"""textloom: a PySpark-native engine for curating and auditing text and code corpora."""
