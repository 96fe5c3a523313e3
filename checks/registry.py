"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    query: Query
    oracle: str | None = None


def check(oracle: str | None = None):
    """Marks a function ``(spark, sf_dir)`` as a query of the function's name."""

    def mark(query: Query) -> Query:
        query.check = Check(query.__name__, query, oracle)
        return query

    return mark


def checks_of(module) -> list[Check]:
    return [value.check for value in vars(module).values() if hasattr(value, "check")]
