"""Column expressions, free of any DataFrame or session."""
