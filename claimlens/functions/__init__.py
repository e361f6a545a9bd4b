"""Column expressions with the database semantics the reports need."""
