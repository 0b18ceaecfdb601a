"""Column expressions and the small array kernels used inside tasks."""
