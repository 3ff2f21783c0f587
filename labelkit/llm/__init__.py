"""Operators of a training-data pipeline; nothing outside of this package imports them."""
