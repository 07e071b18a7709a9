"""Scalar helpers, Column in and Column out."""
