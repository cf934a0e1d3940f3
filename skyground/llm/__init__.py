"""Operators for building training corpora, one module per operator."""
