"""Marketing data integration and reporting on Spark DataFrames."""
