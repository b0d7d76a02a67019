"""Name -> query and name -> SQL.

Doubles are compared as ``round(x + 1e-7, 4)`` on both sides: the shift keeps exact
decimal ties from falling to different sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f"`{n}`").cast("double") + F.lit(1e-7), 4).alias(n) if t in ("double", "float") else F.col(f"`{n}`")
            for n, t in df.dtypes
        ]
    )


def query(name: str, sql: str | None = None, doubles: str = "") -> Callable[[Query], Query]:
    """Register ``name``; ``doubles`` lists the columns of the SQL that are rounded."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(fn(spark, sf_dir))

        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = run
        if sql is not None:
            swaps = ", ".join(f'round("{c}" + 1e-7, 4) AS "{c}"' for c in doubles.split())
            _SQL[name] = f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS q" if swaps else sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
