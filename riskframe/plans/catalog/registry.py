"""Registration of queries together with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.plans.views import Views, with_views

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of the views; ``sql`` may use the views by name."""

    def register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Round floating results whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def joined(array: str | Column, separator: str = "|") -> Column:
    return F.array_join(array, separator)
