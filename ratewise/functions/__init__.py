"""Column expressions: scalar derivations and aggregate statistics."""
