"""Operators and the pipeline for training data: texts in, decisions and files out."""
