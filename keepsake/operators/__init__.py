"""Generic DataFrame operators: they know keys, times and predicates, not the cancel flow."""
