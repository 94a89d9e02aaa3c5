"""Spark-native ingestion, URL canonicalisation, delta detection and dedupe of saved web posts."""
