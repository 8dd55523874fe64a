"""Spark-native curation of image-text training data: filters, dedup, evaluation and training sets as DataFrame plans."""
