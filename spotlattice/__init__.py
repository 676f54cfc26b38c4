"""Spark-native analytics for cell-resolved spatial transcriptomics."""
