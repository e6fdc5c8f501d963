"""Relational operators and per-group kernels."""
