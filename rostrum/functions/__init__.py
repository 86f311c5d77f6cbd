"""Column-level functions: every rule is a native Spark expression."""
