"""A Spark-native warehouse for automotive retail."""
