"""Whole jobs: the model graph, the check suite, ingestion and table publishing."""
