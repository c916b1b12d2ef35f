"""Operators for building language-model training data, and their queries."""
