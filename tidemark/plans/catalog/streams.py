"""Incremental loads run as streams over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.series import lags
from tidemark.plans import roles
from tidemark.plans.catalog import sql as S
from tidemark.plans.catalog.ingest import _NEW, _OLD, old_new
from tidemark.plans.catalog.registry import query
from tidemark.plans.dataset import PRICE
from tidemark.session import scratch_path, settle
from tidemark.sources.snapshots import read_snapshot
from tidemark.streaming import loads


def _events(spark, sf):
    schema = roles.table(spark, sf, "events").schema
    return loads.file_stream(spark, sf, schema, glob="events.parquet")


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events", "value")
def _(spark, sf):
    target = scratch_path(spark, "ingest")
    stream = _events(spark, sf)
    loads.stream_ingest(stream, target, scratch_path(spark, "ingest-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


@query("stream_upsert", f"WITH o AS ({_OLD}), n AS ({_NEW}), u AS (SELECT * FROM n UNION ALL SELECT * FROM o ANTI JOIN n USING (event_id)) "
       "SELECT *, CAST(ts AS DATE) AS day FROM u", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    day = F.to_date("ts").alias("day")
    source, target, state = (scratch_path(spark, f"upsert-{x}") for x in ("source", "target", "state"))
    schema = old.select("*", day).schema
    for part in (old, new):
        part.select("*", day).write.mode("append").parquet(source)
        stream = loads.file_stream(spark, source, schema)
        loads.stream_upsert(stream, target, ["event_id"], "day", state, "last", ["ts"]).awaitTermination()
    return read_snapshot(spark, target, schema)


@query("stream_dedupe", "SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events GROUP BY ALL")
def _(spark, sf):
    stream = _events(spark, sf).withColumn("day", F.to_date("ts"))
    unique = loads.stream_dedupe(stream, ["user_id", "event_type", "day"], "ts", "31 days")
    target = scratch_path(spark, "dedupe")
    kept = unique.select("user_id", "event_type", "day")
    loads.stream_ingest(kept, target, scratch_path(spark, "dedupe-state")).awaitTermination()
    return spark.read.schema(kept.schema).parquet(target)


_LAGS = ", ".join(f"lag(Average_Price, {k}) OVER ({S.W}) AS lag{k}" for k in fixed.MODEL_LAGS)


@query("stream_features", f"WITH {S.FILLED} SELECT series_id, d, Average_Price, {_LAGS} FROM filled",
       "Average_Price " + " ".join(f"lag{k}" for k in fixed.MODEL_LAGS))
def _(spark, sf):
    """The days come in three loads: most of the past, with some missing and some wrong; these, late and corrected; the newest."""
    daily = settle(roles.daily_quotes(spark, sf).select("series_id", "d", PRICE))
    source, target, state = (scratch_path(spark, f"features-{x}") for x in ("source", "target", "state"))
    recent = F.col("d") >= F.date_sub(F.lit(daily.agg(F.max("d")).first()[0]), 100)
    turn = F.pmod(F.xxhash64("series_id", "d"), F.lit(1000))
    wrong = daily.withColumn(PRICE, F.when(turn >= 995, F.col(PRICE) * 2).otherwise(F.col(PRICE)))
    for load in (wrong.where(~recent & (turn >= 5)), daily.where(~recent & ((turn < 5) | (turn >= 995))), daily.where(recent)):
        load.write.mode("append").parquet(source)
        stream = loads.file_stream(spark, source, daily.schema)
        made = lambda filled: lags(filled, PRICE, fixed.MODEL_LAGS)
        loads.stream_features(stream, target, PRICE, made, max(fixed.MODEL_LAGS), state).awaitTermination()
    return read_snapshot(spark, f"{target}/features", loads.with_months(made(daily)).schema).drop(loads.MONTH)
