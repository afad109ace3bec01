"""quern: a PySpark-native engine for language-model training corpora."""
