"""textlab: Spark-native training, scoring and auditing of text classifiers."""

__version__ = "0.1.0"
