"""Scalar helpers and the fixed rule tables."""

from clinframe.functions import expr, rules  # noqa: F401
