"""Tidemark: a document lakehouse and retrieval engine written as Spark jobs."""
