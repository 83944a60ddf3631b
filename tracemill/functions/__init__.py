"""Column expressions: paths, task text, numbers, recordings."""
