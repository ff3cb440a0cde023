"""Corpus operators for training-data pipelines. Nothing else in terrabrook imports this subpackage."""
