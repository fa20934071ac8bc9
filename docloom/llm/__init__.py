"""Operators of a training-data pipeline; nothing outside of this subpackage imports it."""
