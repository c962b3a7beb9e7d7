"""Registered queries: each operator on the given tables, beside the same in SQL."""

from . import cleaning, files, lookups, modelling, profiles, series, text  # noqa: F401
from .common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
