"""Operators for preparing language-model training data, each with its query and SQL."""
