"""Column -> Column expressions.  All are built-in Spark SQL functions, so they
stay inside whole-stage code generation; no Python runs per row."""
