"""Operators: functions from DataFrames to DataFrames, whatever their tables are called."""
