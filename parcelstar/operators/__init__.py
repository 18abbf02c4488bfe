"""DataFrame operators: cleaning, keys, joins, facts, checks."""
