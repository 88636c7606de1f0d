"""Registered queries, each with the SQL that must give the same rows."""

from touchline.catalog import (  # noqa: F401
    aggregates,
    cleaning,
    imputing,
    joins,
    modelling,
    profiling,
    reshaping,
    whole,
)
from touchline.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
