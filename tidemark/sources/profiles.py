"""Stored profiles: how often each value of a feature occurs on each day, kept up to date by what changes.

Counts add up, so late rows append theirs, a corrected row appends one less of its old value and one more of
its new one, and a window is the sum over its days. A check of one day reads that day's month alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.drift import value_counts
from tidemark.sources.snapshots import append_snapshot, read_snapshot

_SCHEMA = StructType().add("feature", "string").add("d", "date").add("value", "double").add("n", "long").add("month", "date")


def append_profiles(target: str, new: DataFrame | None, cols: Sequence[str], old: DataFrame | None = None, d: str = "d") -> None:
    """Count the rows of ``new`` in and those of ``old`` out; rows without a day are left out. Each change is given once."""
    parts: list[DataFrame] = []
    for rows, sign in ((new, 1), (old, -1)):
        if rows is not None:
            known = rows.where(F.col(d).isNotNull()).withColumnRenamed(d, "d")
            parts.append(value_counts(known, cols, ["d"]).withColumn("n", F.col("n") * sign))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    append_snapshot(target, both.select("feature", "d", "value", "n", F.trunc("d", "month").alias("month")), "month")


def read_profiles(spark: SparkSession, target: str, first: dt.date, last: dt.date) -> DataFrame:
    """``(feature, value, n)`` of the days ``first`` to ``last``; only their months are read."""
    months = spark.range(1).select(
        F.explode(F.sequence(F.trunc(F.lit(first), "month"), F.lit(last), F.expr("interval 1 month"))).alias("month")
    )
    days = read_snapshot(spark, target, _SCHEMA, "month", months).where(F.col("d").between(first, last))
    return days.groupBy("feature", "value").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
