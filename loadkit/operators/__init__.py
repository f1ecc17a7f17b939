"""Operators: functions from DataFrames to DataFrames. None calls current_timestamp()."""
