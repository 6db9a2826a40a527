"""Operators for training-data corpora. Nothing outside this folder, its tests and the pipeline imports them."""
