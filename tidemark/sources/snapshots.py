"""Stored tables whose readers see a whole old state or a whole new one.

A table is a folder of versions. Each upsert writes the partitions it changes into a version of its own and then a
manifest: which versions hold each partition (appends add one, upserts leave one). A manifest counts once Spark has marked it as complete, which is one
file appearing; until then readers use the one before, and files that no manifest names are never read. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import _file_system, delete_path, path_exists, settle
from tidemark.sources.increments import upsert

_PLACE = "_place"


def _place(part: str) -> Column:
    """The folder name of a partition value, whatever its type."""
    return F.md5(F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit("")))


def _latest(spark: SparkSession, target: str) -> int:
    """Number of the newest complete manifest, 0 if there is none."""
    store, where = _file_system(spark, f"{target}/manifests")
    if not store.exists(where):
        return 0
    names = [entry.getPath().getName() for entry in store.listStatus(where)]
    return max((int(n) for n in names if n.isdigit() and path_exists(spark, f"{target}/manifests/{n}/_SUCCESS")), default=0)


def _manifest(spark: SparkSession, target: str, number: int | None = None) -> dict[str, list[str]]:
    """Versions of each partition."""
    number = _latest(spark, target) if number is None else number
    if not number:
        return {}
    rows = spark.read.schema("place string, version string").parquet(f"{target}/manifests/{number}").collect()
    held: dict[str, list[str]] = {}
    for r in rows:
        held.setdefault(r.place, []).append(r.version)
    return held


def _read(spark: SparkSession, target: str, schema: StructType, held: dict[str, list[str]]) -> DataFrame:
    paths = [f"{target}/versions/{version}/{_PLACE}={place}" for place, versions in sorted(held.items()) for version in versions]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_snapshot(spark: SparkSession, target: str, schema: StructType, part: str | None = None, values: DataFrame | None = None) -> DataFrame:
    """The table as of now. ``values``: a table with the column ``part``; only partitions of its values are read."""
    held = _manifest(spark, target)
    if values is not None:
        wanted = {r[0] for r in values.select(_place(part)).distinct().collect()}  # as many as there are partitions
        held = {place: versions for place, versions in held.items() if place in wanted}
    return _read(spark, target, schema, held)


def upsert_snapshot(target: str, new: DataFrame, key: Sequence[str], part: str, keep: str = "last", order: Sequence[str] = ()) -> None:
    """Upsert into the partitions that ``new`` touches; each is read and written once.

    ``part`` must be a function of the key; a key with two parts in ``new`` raises. Repeating a call that has ended or
    broken off gives the same table. No rows change nothing.
    """
    spark, schema = new.sparkSession, new.schema
    new = settle(new, "batch")
    if part not in key:
        twice = new.groupBy(*key).agg(F.min(part).alias("_a"), F.max(part).alias("_b")).where("_a <> _b")
        if not twice.isEmpty():
            raise ValueError(f"{part} differs between rows of one key")
    places = [r[0] for r in new.select(_place(part)).distinct().collect()]
    if not places:
        return
    number, version = _latest(spark, target), uuid.uuid4().hex
    held = _manifest(spark, target, number)
    old = _read(spark, target, schema, {p: held[p] for p in places if p in held})
    merged = upsert(old, new, key, keep, order)
    _commit(target, merged, part, version, number, {**held, **dict.fromkeys(places, [version])})


def append_snapshot(target: str, new: DataFrame, part: str) -> None:
    """Add rows to their partitions; nothing of the table is read or written again. No rows change nothing."""
    spark = new.sparkSession
    new = settle(new, "batch")
    number, version = _latest(spark, target), uuid.uuid4().hex
    held = _manifest(spark, target, number)
    places = [r[0] for r in new.select(_place(part)).distinct().collect()]
    if places:
        _commit(target, new, part, version, number, {**held, **{p: [*held.get(p, []), version] for p in places}})


def _commit(target: str, rows: DataFrame, part: str, version: str, number: int, held: dict[str, list[str]]) -> None:
    """Write a version, and then the manifest that makes it count."""
    rows.withColumn(_PLACE, _place(part)).write.partitionBy(_PLACE).parquet(f"{target}/versions/{version}")
    named = [(place, v) for place, versions in held.items() for v in versions]
    listed = rows.sparkSession.createDataFrame(named, "place string, version string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifests/{number + 1}")


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Delete what only manifests before the last ``keep`` name, for when no reader uses these any more."""
    latest = _latest(spark, target)
    kept = {v for n in range(max(1, latest - keep + 1), latest + 1) for versions in _manifest(spark, target, n).values() for v in versions}
    store, where = _file_system(spark, f"{target}/versions")
    for entry in store.listStatus(where) if store.exists(where) else ():
        if entry.getPath().getName() not in kept:
            delete_path(spark, entry.getPath().toString())
    for n in range(1, latest - keep + 1):
        delete_path(spark, f"{target}/manifests/{n}")
