"""DataFrame operators: aggregates, joins, detection, models, forecasting."""
