"""driftmark: a Spark-native engine that keeps a chunk-level index in step with changing documents."""

__version__ = "0.1.0"
