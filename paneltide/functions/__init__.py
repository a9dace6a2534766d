"""Column-level functions: exact arithmetic helpers, flags and parsing,
distribution functions, spherical geometry."""
