"""Operators for training-data pipelines.

Every module takes DataFrames and column names and returns DataFrames; nothing
else in the library imports this package.
"""
