"""Operators: functions from DataFrame to DataFrame, planned by Catalyst."""
