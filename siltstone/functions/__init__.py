"""Column functions. All are compositions of Spark's own functions, so they stay inside its code generation."""
