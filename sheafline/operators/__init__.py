"""DataFrame operators: selectors, joins, statistics, validation, maintenance."""
