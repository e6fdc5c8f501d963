"""Plain functions that kernels call inside tasks."""
