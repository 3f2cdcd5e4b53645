"""Column functions: stateless and evaluated by Spark's own expressions."""
