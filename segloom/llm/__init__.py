"""Operators for training-data pipelines. Nothing in the core imports this subpackage."""
