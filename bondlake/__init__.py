"""bondlake: a PySpark-native engine for public-bond disclosure documents."""
