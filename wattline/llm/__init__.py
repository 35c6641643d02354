"""Corpus operators for training data: text, embeddings, pages and shards."""
