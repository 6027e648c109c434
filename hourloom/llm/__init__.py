"""Operators of a training-data pipeline over web documents, and their named queries."""
