"""High-water marks, upserts and appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import delete_path, path_exists


def new_rows(
    src: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = (),
    d: str = "d",
    default: str = "2021-12-31",
    until: str | None = None,
) -> DataFrame:
    """Rows of ``src`` later than the newest one in ``target`` (and not after ``until``).

    Without keys the mark is one scalar for the whole table. With keys it is one mark
    per key, joined back; how large that side is decides the join at run time.
    """
    start = F.lit(default).cast(src.schema[d].dataType)
    if until is not None:
        src = src.where(F.col(d) <= F.lit(until).cast(src.schema[d].dataType))
    if not keys:
        mark = target.agg(F.max(d)).scalar()
        return src.where(F.col(d) > F.coalesce(mark, start))
    marks = target.groupBy(*keys).agg(F.max(d).alias("_mark"))
    joined = src.join(marks, list(keys), "left")
    return joined.where(F.col(d) > F.coalesce("_mark", start)).drop("_mark")


def dedupe_by(
    df: DataFrame, key: Sequence[str], order: Sequence[str | Column], keep: str = "first"
) -> DataFrame:
    """One row per key, the first or last by ``order``.

    Ranking with a limit of one is cut down before the shuffle as well, so a key that
    owns a large share of the rows ships one row per input task.
    """
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    cols = [c.asc() if keep == "first" else c.desc() for c in cols]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*cols)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def upsert(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    keep: str = "first",
    order: Sequence[str] = (),
) -> DataFrame:
    """Old and new rows together, one per key.

    ``keep="first"``: an existing row wins and corrections are ignored.
    ``keep="last"``: the newest row wins. ``order`` settles repeats inside one side.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return dedupe_by(both, key, ["_side", *order], keep).drop("_side")


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """UNION ALL by name: a repeated delivery stays repeated."""
    return old.unionByName(new)


def dedupe(df: DataFrame, date_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct rows; ``date_cols`` are compared as dates whatever type they came in."""
    for c in date_cols:
        df = df.withColumn(c, F.col(c).cast("date"))
    return df.distinct()


#: Partition values that one upsert may name in its filter; with more of them the old rows are found by a join.
MOST_TOUCHED = 10_000


def touched_rows(old: DataFrame, new: DataFrame, part: str) -> DataFrame:
    """Rows of ``old`` in the partitions that ``new`` touches; only those partitions are read.

    The few partition values come to the driver and go into the filter. A batch that
    touches more than ``MOST_TOUCHED`` partitions reads them by a join.
    """
    values = [r[0] for r in new.select(part).distinct().limit(MOST_TOUCHED + 1).collect()]
    if len(values) > MOST_TOUCHED:
        return old.join(new.select(part).distinct(), old[part].eqNullSafe(new[part]), "left_semi")
    known = [v for v in values if v is not None]
    hit = F.col(part).isin(known) if known else F.lit(False)
    return old.where(hit | F.col(part).isNull() if len(known) < len(values) else hit)


def _replace_partitions(spark: SparkSession, staged: str, target: str, schema: StructType, part: str) -> None:
    (
        spark.read.schema(schema).parquet(staged).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(target)
    )


def upsert_partitions(
    target: str, new: DataFrame, key: Sequence[str], part: str, keep: str = "last", order: Sequence[str] = ()
) -> None:
    """Upsert into a Parquet table partitioned by ``part``, reading and writing only those partitions.

    ``part`` must be a function of the key; a key with two parts in ``new`` raises. The merged
    partitions are first written to ``_upsert`` below the table, where readers do not look, and
    then replace the old ones. If the job ends in between, the next call finishes that
    replacement from the written copy before anything else, so no row is lost.
    """
    spark, schema, staged = new.sparkSession, new.schema, f"{target}/_upsert"
    if part not in key:
        twice = new.groupBy(*key).agg(F.min(part).alias("_a"), F.max(part).alias("_b")).where("_a <> _b")
        if not twice.isEmpty():
            raise ValueError(f"{part} differs between rows of one key")
    if path_exists(spark, f"{staged}/_SUCCESS"):
        _replace_partitions(spark, staged, target, schema, part)
    delete_path(spark, staged)
    try:
        old = spark.read.schema(schema).parquet(target)
    except AnalysisException as err:  # first load
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        old = spark.createDataFrame([], schema)
    upsert(touched_rows(old, new, part), new, key, keep, order).write.partitionBy(part).parquet(staged)
    _replace_partitions(spark, staged, target, schema, part)
    delete_path(spark, staged)
