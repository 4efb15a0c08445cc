"""Table-in, table-out analytics and machine-learning jobs on Spark DataFrames."""
