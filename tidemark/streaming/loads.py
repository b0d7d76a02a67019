"""Incremental file loads, upserts and de-duplication as Structured Streaming jobs.

Each run works off what is new and stops (``availableNow``). The checkpoint folder
remembers which files are done, so a run after a lost executor or a restart continues
where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.fill import ffill
from tidemark.operators.series import D, KEYS, densify
from tidemark.session import settle
from tidemark.sources.increments import dedupe_by
from tidemark.sources.snapshots import append_snapshot, read_snapshot, upsert_snapshot


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files below ``path``, read with an explicit schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append new rows to a Parquet table, each file exactly once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_upsert(
    stream: DataFrame,
    target: str,
    key: Sequence[str],
    part: str,
    checkpoint: str,
    keep: str = "last",
    order: Sequence[str] = (),
) -> StreamingQuery:
    """Upsert every micro-batch into the partitions of a snapshot table that it touches (see ``sources.snapshots``).

    Repeating a batch after a failure gives the same table, as the same rows win again.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert_snapshot(target, batch, key, part, keep, order)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


MONTH = "month"


def with_months(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.trunc(D, "month"))


def _months(spans: DataFrame, first: str, last: str) -> DataFrame:
    """Months that the ranges of days touch."""
    days = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return spans.select(F.explode(days).alias(MONTH)).distinct()


def _within(target: str, schema: T.StructType, spans: DataFrame, first: str, last: str) -> DataFrame:
    """Rows of a snapshot table in each series' range of days, with the range; only the months of these ranges are read."""
    rows = read_snapshot(spans.sparkSession, target, schema, MONTH, _months(spans, first, last))
    return rows.join(spans, list(KEYS)).where(F.col(D).between(F.col(first), F.col(last)))


def _neighbour(spans: DataFrame, known: str, schema: T.StructType, ahead: bool, step: int = 31) -> DataFrame:
    """``spans`` (keys, first, last) with ``day``: the known day next behind ``last``, or before ``first``; NULL if there is none.

    It is looked for ``step`` days on, for those without one in twice as many, and so on to the end of the table.
    """
    keys, days = list(KEYS), read_snapshot(spans.sparkSession, known, schema)
    end = days.agg(F.max(D) if ahead else F.min(D)).first()[0]  # from the footers of the files
    found, left = [], spans
    while True:
        if ahead:
            looked = left.withColumns({"from": F.col("last"), "to": F.date_add("last", step)})
            day, over = F.min(F.when(F.col(D) > F.col("last"), F.col(D))), F.col("to") >= F.lit(end)
        else:
            looked = left.withColumns({"from": F.date_sub("first", step), "to": F.col("first")})
            day, over = F.max(F.when(F.col(D) < F.col("first"), F.col(D))), F.col("from") <= F.lit(end)
        near = _within(known, schema, looked, "from", "to").groupBy(*keys).agg(day.alias("day"))
        seen = settle(looked.join(near, keys, "left"), "seen")
        done = F.col("day").isNotNull() | over
        found.append(seen.where(done).select(*spans.columns, "day"))
        left = seen.where(~done).select(*spans.columns)
        if left.isEmpty():
            return reduce(DataFrame.unionByName, found)
        step *= 2


def recompute(batch: DataFrame, target: str, value: str, features: Callable[[DataFrame], DataFrame], reach: int) -> None:
    """Bring a feature table up to date with changed days of some series.

    ``batch`` has days (keys, day, ``value``) that are new, late or corrected. Three snapshot tables by month lie below
    ``target``: ``days`` as they came, ``filled`` with the calendar closed and the value carried forward, and
    ``features``, which is ``features(filled)``; that may look back ``reach`` days. What a change reaches:

    * filled days behind the last known day before the first changed one, up to the next known day behind the last
      changed one, or to the series' end;
    * features of these days and of ``reach`` days more, from filled days that begin ``reach`` days earlier.

    Only the months of these ranges are read and written. An empty batch changes nothing.
    """
    keys, known = list(KEYS), f"{target}/days"
    changed = settle(with_months(batch.select(*keys, D, value)), "changed")
    if changed.isEmpty():
        return
    schema, shown = changed.schema, [*keys, D, value]
    upsert_snapshot(known, changed, [*keys, D], MONTH)
    spans = settle(changed.groupBy(*keys).agg(F.min(D).alias("first"), F.max(D).alias("last")), "spans")
    spans = _neighbour(spans, known, schema, True).withColumnRenamed("day", "next")
    spans = settle(spans, "spans")
    spans = _neighbour(spans, known, schema, False).select(
        *keys, F.coalesce("day", "first").alias("begin"), F.coalesce("next", "last").alias("end"),
        F.coalesce(F.date_add("day", 1), F.col("first")).alias("first"), F.coalesce(F.date_sub("next", 1), F.col("last")).alias("last"),
    )
    spans = settle(spans.withColumns({"from": F.date_sub("first", reach), "to": F.date_add("last", reach)}), "spans")
    rows = _within(known, schema, spans, "begin", "end").select(*shown)
    new = ffill(densify(rows), [value]).join(spans, keys).where(F.col(D).between(F.col("first"), F.col("last"))).select(*shown)
    upsert_snapshot(f"{target}/filled", with_months(new), [*keys, D], MONTH)
    around = _within(f"{target}/filled", schema, spans, "from", "to").select(*shown)
    made = features(around).join(spans.select(*keys, "first", "to"), keys).where(F.col(D).between(F.col("first"), F.col("to")))
    upsert_snapshot(f"{target}/features", with_months(made.drop("first", "to")), [*keys, D], MONTH)


def stream_features(
    stream: DataFrame, target: str, value: str, features: Callable[[DataFrame], DataFrame], reach: int, checkpoint: str
) -> StreamingQuery:
    """``recompute`` for every micro-batch; of several rows of one day in a batch the largest value counts."""

    def run(batch: DataFrame, _: int) -> None:
        recompute(batch.groupBy(*KEYS, D).agg(F.max(value).alias(value)), target, value, features, reach)

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_dedupe(stream: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key; the state forgets a key once the watermark has passed it by ``delay``."""
    stamped = stream
    if stream.schema[ts].dataType.simpleString() == "timestamp_ntz":
        stamped = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stamped.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def stream_first(
    stream: DataFrame, target: str, key: Sequence[str], checkpoint: str, order: Sequence[str], buckets: int = 256
) -> StreamingQuery:
    """Append the rows whose key the table does not have yet, the first of each key by ``order``.

    The table itself is the memory: nothing is forgotten, however late a row comes, and there is no
    state that grows. It is a snapshot table with ``buckets`` partitions by the hash of the key; a batch reads
    only the buckets of its keys and only their key columns.
    """

    def add(batch: DataFrame, _: int) -> None:
        add_first(batch, target, key, order, buckets)

    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


BUCKET = "bucket"


def add_first(batch: DataFrame, target: str, key: Sequence[str], order: Sequence[str], buckets: int = 256) -> None:
    """One batch of ``stream_first``; repeating it adds nothing."""
    numbered = dedupe_by(batch, key, order).withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    numbered = settle(numbered, "numbered")
    seen = read_snapshot(batch.sparkSession, target, numbered.schema, BUCKET, numbered).select(*key)
    append_snapshot(target, numbered.join(seen, list(key), "left_anti").select(*numbered.columns), BUCKET)


def first_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The table that ``stream_first`` keeps."""
    return read_snapshot(spark, target, T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).drop(BUCKET)
