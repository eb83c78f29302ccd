"""Turnloom: Spark-native processing of meeting transcripts and other text corpora."""
