"""Table-level operators: joins, aggregates, windows, splits, profiles."""
