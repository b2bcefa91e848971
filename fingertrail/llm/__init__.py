"""Operators of a training-data pipeline over document tables; nothing else in the package imports them."""
