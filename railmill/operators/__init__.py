"""DataFrame operators: dedup, joins, aggregates, filters, arrays and quality checks."""
