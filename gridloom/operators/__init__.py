"""Array operators: DataFrame in, DataFrame out."""
