"""Column-level functions: casts, calendar, value maps, noise."""
