"""Column-expression and join helpers shared by the operators."""
