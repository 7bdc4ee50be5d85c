"""provlake: product-page batches as Spark DataFrames, from raw links to traceable tables."""
