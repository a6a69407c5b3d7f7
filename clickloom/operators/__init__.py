"""Operators: functions from DataFrames to DataFrames, usable in batch."""
