"""Column expressions and predicates."""
