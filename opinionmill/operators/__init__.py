"""DataFrame operators: contracts, joins, aggregates, ranking, features, models, metrics."""
