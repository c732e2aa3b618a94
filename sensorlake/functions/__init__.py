"""Column expressions; every one stays inside whole-stage code generation."""
