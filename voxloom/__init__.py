"""Spark-native auditing, triage and preparation of speech-text corpora."""
