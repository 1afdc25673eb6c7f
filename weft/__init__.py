"""A Spark-native engine for record linkage: normalising, retrieving, comparing, deciding and checking."""
