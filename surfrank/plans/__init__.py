"""Execution plans: matrix layout for repeated multiplication and the convergence loop."""
