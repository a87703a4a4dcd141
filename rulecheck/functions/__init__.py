"""Column-expression functions: placeholder rendering, measure coercion, percentages."""
