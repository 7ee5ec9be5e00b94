"""tripmart: batch and incremental analytics over trip records, written as Spark DataFrames."""
