"""DataFrame -> DataFrame operators (filters, joins, windows, aggregates)."""
