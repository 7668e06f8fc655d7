"""A Spark-native engine for mirrored text corpora and entity analytics."""
