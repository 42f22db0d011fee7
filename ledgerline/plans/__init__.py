"""Whole programs over the operators: build, nightly difference, extraction, search, and the query catalogue."""
