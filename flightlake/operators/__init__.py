"""DataFrame -> DataFrame operators: cleaning, joins, range joins,
aggregates, ranking and the extraction transforms."""
