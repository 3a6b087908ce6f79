"""Sales-warehouse analytics built on PySpark DataFrames."""
