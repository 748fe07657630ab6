"""presslake: a PySpark-native engine for press-release and news-page corpora."""
