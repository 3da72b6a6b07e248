"""Operators for building training corpora: one module per operator, and the queries that apply them."""
