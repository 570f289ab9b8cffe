"""The models, reports and checks: functions from DataFrames to a DataFrame."""
