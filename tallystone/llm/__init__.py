"""Operators for building training data: each module holds one, ``queries`` registers them."""
