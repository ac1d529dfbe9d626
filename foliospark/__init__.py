"""Spark-native engine for document ingestion, deduplication, chunking, retrieval and source audit."""
