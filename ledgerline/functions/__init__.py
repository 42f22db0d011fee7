"""Column functions: normalisation, predicates, text parsers, search."""
