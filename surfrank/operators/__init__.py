"""Graph, matrix and block operators: DataFrame in, DataFrame out."""
