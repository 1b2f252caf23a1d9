"""Column expressions. All are built-in Spark expressions, so they stay inside code generation."""
