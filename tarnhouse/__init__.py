"""A Spark-native toolkit for a small dimensional lakehouse and its reports."""
