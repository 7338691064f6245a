"""lectern: edition-catalog analytics on PySpark DataFrames."""
