"""Evidence mining on Spark: sources, operators, plans and streaming over DataFrames."""
