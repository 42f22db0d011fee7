"""DataFrame operators: folds, duplicates, joins, differences, guards, reports."""
