"""Operators of a training-data pipeline: texts, pages and embeddings at corpus scale."""
