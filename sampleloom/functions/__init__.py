"""Column expressions: ids, predicates, labels, arithmetic, optimizer rules."""
