"""Table cleaning, statistics, text and model jobs on PySpark DataFrames."""
