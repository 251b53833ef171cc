"""Star-schema building blocks on plain Spark DataFrames."""
