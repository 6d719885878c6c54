"""Claims analytics on Spark: functions that take and return DataFrames."""
