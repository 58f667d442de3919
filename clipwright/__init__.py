"""Spark-native engine for speech/video manifests and training-data preparation."""

__version__ = "0.1.0"
