"""Column factories: named filters, expressions and the one rate definition."""
