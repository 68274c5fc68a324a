"""Operators for training data: one module for each; `queries` registers them."""
