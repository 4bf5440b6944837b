"""Operators for preparing training data at scale, and the corpus pipeline's parts."""
