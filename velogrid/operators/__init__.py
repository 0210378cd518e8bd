"""Data operators: cleaning, joins, the dense grid, splits, metrics, profiles."""
