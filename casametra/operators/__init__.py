"""Operators: DataFrame to DataFrame, one concern per module."""
