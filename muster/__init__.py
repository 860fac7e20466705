"""muster: a Spark-native engine for run-based conformance censuses."""
