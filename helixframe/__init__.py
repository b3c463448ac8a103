"""Spark-native annotation and classification of RNA transcripts."""
