"""Column expressions: sphere geometry, WCS, names and paths."""
