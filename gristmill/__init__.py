"""gristmill: a Spark-native engine for curating and evaluating large training corpora."""

__version__ = "0.1.0"
