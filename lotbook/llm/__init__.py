"""Operators for large training-data pipelines over text and embeddings."""
