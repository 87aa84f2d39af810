"""Operators for training-data pipelines: ten corpus operators over documents, pages and embeddings."""
