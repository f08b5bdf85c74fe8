"""Scalar functions: dates, JSON, money."""

from . import dates, json_ops, money  # noqa: F401
