"""Column expressions: instants, text, change records, projections."""
