"""Product recommendations on PySpark: functions from DataFrames to DataFrames."""
