"""Operators: functions from DataFrames to DataFrames. None of them owns a session."""
