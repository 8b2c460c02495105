"""Operators from DataFrame to DataFrame, generic over column names."""
