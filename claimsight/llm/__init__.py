"""Operators for preparing training text, written on DataFrames.

Nothing else in the library imports this subpackage. Each module holds one operator;
``queries`` registers one query per operator.
"""
