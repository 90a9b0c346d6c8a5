"""Column-expression helpers (nested paths, one-hot) and distributed ordering helpers."""
