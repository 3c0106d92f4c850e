"""lexitrack: vocabulary study data on Spark DataFrames."""
