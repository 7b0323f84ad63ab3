"""Operators on texts for training data of language models."""
