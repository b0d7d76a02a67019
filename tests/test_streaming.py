from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import TESTDATA
from tidemark.plans import roles
from tidemark.session import delete_path, path_exists, scratch_path
from tidemark.sources import increments, snapshots
from tidemark.sources.snapshots import read_snapshot
from tidemark.streaming import loads

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.DoubleType()), T.StructField("day", T.DateType())])


@pytest.fixture
def paths(spark):
    return {n: scratch_path(spark, n) for n in ("source", "target", "state")}


def put(spark, path, rows):
    full = [(k, t, v, t.date()) for k, t, v in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_second_run_sees_only_new_files(spark, paths):
    def run():
        stream = loads.file_stream(spark, paths["source"], SCHEMA)
        query = loads.stream_ingest(stream, paths["target"], paths["state"])
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    put(spark, paths["source"], [(1, at(1), 1.0), (2, at(1), 2.0)])
    assert run() == 2
    put(spark, paths["source"], [(3, at(2), 3.0)])
    assert run() == 1
    assert run() == 0
    got = spark.read.schema(SCHEMA).parquet(paths["target"])
    want = spark.read.schema(SCHEMA).parquet(paths["source"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("keep", ["first", "last"])
def test_stream_upsert_equals_batch_upsert(spark, paths, keep):
    batches = [
        [(1, at(1), 1.0), (2, at(2), 2.0)],
        [(1, at(1), 10.0), (3, at(2), 3.0)],
        [(3, at(2), 30.0), (4, at(9), 4.0)],
    ]
    batch = None
    for rows in batches:
        put(spark, paths["source"], rows)
        stream = loads.file_stream(spark, paths["source"], SCHEMA)
        loads.stream_upsert(stream, paths["target"], ["k", "day"], "day", paths["state"], keep, ["ts"]).awaitTermination()
        new = spark.createDataFrame([(k, t, v, t.date()) for k, t, v in rows], SCHEMA)
        batch = new if batch is None else increments.upsert(batch, new, ["k", "day"], keep, ["ts"])
    got = read_snapshot(spark, paths["target"], SCHEMA)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_dedupe_keeps_one_row_across_batches(spark, paths):
    put(spark, paths["source"], [(1, at(1), 1.0), (1, at(1, 5), 1.0)])

    def run():
        stream = loads.file_stream(spark, paths["source"], SCHEMA)
        unique = loads.stream_dedupe(stream, ["k", "v"], "ts", "2 days").select("k", "v")
        loads.stream_ingest(unique, paths["target"], paths["state"]).awaitTermination()
        return sorted(map(tuple, spark.read.schema("k int, v double").parquet(paths["target"]).collect()))

    assert run() == [(1, 1.0)]
    put(spark, paths["source"], [(1, at(2), 1.0), (2, at(2), 1.0)])
    assert run() == [(1, 1.0), (2, 1.0)]


def test_ingest_of_a_given_table(spark, paths):
    schema = roles.table(spark, TESTDATA, "events").schema
    stream = loads.file_stream(spark, TESTDATA, schema, glob="events.parquet")
    loads.stream_ingest(stream, paths["target"], paths["state"]).awaitTermination()
    got = spark.read.schema(schema).parquet(paths["target"])
    assert got.agg(F.count("*"), F.sum("event_id")).first() == roles.table(spark, TESTDATA, "events").agg(F.count("*"), F.sum("event_id")).first()


def test_an_upsert_that_ends_between_delete_and_write_loses_nothing(spark, paths, monkeypatch):
    def frame(rows):
        return spark.createDataFrame([(k, t, v, t.date()) for k, t, v in rows], SCHEMA)

    def read():
        return sorted((r.k, r.v) for r in spark.read.schema(SCHEMA).parquet(paths["target"]).collect())

    def broken(spark, staged, target, schema, part):
        delete_path(spark, f"{target}/day=2024-01-01")
        raise RuntimeError("executor lost")

    increments.upsert_partitions(paths["target"], frame([(1, at(1), 1.0), (2, at(1), 2.0), (3, at(5), 3.0)]), ["k", "day"], "day")
    with monkeypatch.context() as m:
        m.setattr(increments, "_replace_partitions", broken)
        with pytest.raises(RuntimeError):
            increments.upsert_partitions(paths["target"], frame([(2, at(1), 20.0)]), ["k", "day"], "day")
    assert read() == [(3, 3.0)]  # the old partition is gone, its replacement not yet there
    increments.upsert_partitions(paths["target"], frame([(4, at(5), 4.0)]), ["k", "day"], "day")
    assert read() == [(1, 1.0), (2, 20.0), (3, 3.0), (4, 4.0)]
    assert not path_exists(spark, paths["target"] + "/_upsert")


def test_a_key_in_two_parts_is_refused(spark, paths):
    new = spark.createDataFrame([(1, at(1), 1.0, at(1).date()), (1, at(2), 1.0, at(2).date())], SCHEMA)
    with pytest.raises(ValueError, match="day differs"):
        increments.upsert_partitions(paths["target"], new, ["k"], "day")


def _rows(spark, rows):
    return spark.createDataFrame([(k, t, v, t.date()) for k, t, v in rows], SCHEMA)


def _seen(spark, target):
    return sorted((r.k, r.v) for r in read_snapshot(spark, target, SCHEMA).collect())


def test_readers_see_the_old_or_the_new_table(spark, paths, monkeypatch):
    """Also one that began before an upsert, and one that comes while it is broken off."""
    target = paths["target"]
    snapshots.upsert_snapshot(target, _rows(spark, [(1, at(1), 1.0), (2, at(1), 2.0), (3, at(5), 3.0)]), ["k", "day"], "day")
    before = read_snapshot(spark, target, SCHEMA)
    new = _rows(spark, [(2, at(1), 20.0)])
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_commit", lambda target, rows, part, version, *_: rows.write.parquet(f"{target}/versions/{version}") or 1 / 0)
        with pytest.raises(ZeroDivisionError):
            snapshots.upsert_snapshot(target, new, ["k", "day"], "day")
    assert _seen(spark, target) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    delete_path(spark, f"{target}/manifests/2")
    spark.createDataFrame([("x", "y")], "place string, version string").write.parquet(f"{target}/manifests/2")
    delete_path(spark, f"{target}/manifests/2/_SUCCESS")  # a manifest that was not finished
    assert _seen(spark, target) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    for _ in range(2):  # repeating changes nothing
        snapshots.upsert_snapshot(target, new, ["k", "day"], "day")
        assert _seen(spark, target) == [(1, 1.0), (2, 20.0), (3, 3.0)]
    assert sorted((r.k, r.v) for r in before.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    snapshots.vacuum(spark, target, 1)
    assert _seen(spark, target) == [(1, 1.0), (2, 20.0), (3, 3.0)]


def test_snapshots_of_odd_partitions(spark, paths):
    target, schema = paths["target"], "k int, part string, v int"
    snapshots.upsert_snapshot(target, spark.createDataFrame([], schema), ["k"], "part")
    assert read_snapshot(spark, target, spark.createDataFrame([], schema).schema).count() == 0
    rows = [(1, None, 1), (2, "", 2), (3, "a/b=c %", 3), (4, "__HIVE_DEFAULT_PARTITION__", 4)]
    snapshots.upsert_snapshot(target, spark.createDataFrame(rows, schema), ["k"], "part")
    snapshots.append_snapshot(target, spark.createDataFrame([(5, None, 5)], schema), "part")
    got = read_snapshot(spark, target, spark.createDataFrame([], schema).schema)
    assert sorted(map(tuple, got.collect())) == [*rows, (5, None, 5)]
    some = read_snapshot(spark, target, got.schema, "part", spark.createDataFrame([(None,), ("a/b=c %",)], "part string"))
    assert sorted(r.k for r in some.collect()) == [1, 3, 5]
    with pytest.raises(ValueError, match="part differs"):
        snapshots.upsert_snapshot(target, spark.createDataFrame([(1, "x", 1), (1, "y", 1)], schema), ["k"], "part")


def test_a_first_row_reads_only_the_buckets_of_its_batch(spark, paths, monkeypatch):
    read = []

    def spied(*given, build=loads.read_snapshot):
        read.append(build(*given))
        return read[-1]

    target = paths["target"]
    loads.add_first(_rows(spark, [(k, at(1), float(k)) for k in range(200)]), target, ["k"], ["ts"])
    monkeypatch.setattr(loads, "read_snapshot", spied)
    late = _rows(spark, [(7, at(1), 70.0), (7, at(2), 71.0), (500, at(3), 500.0), (500, at(2), 501.0)])
    for _ in range(2):
        loads.add_first(late, target, ["k"], ["ts"])
    assert all(len({f.split("_place=")[1].split("/")[0] for f in df.inputFiles()}) <= 2 for df in read)
    got = {r.k: r.v for r in loads.first_rows(spark, target, SCHEMA).collect()}
    assert got == {**{k: float(k) for k in range(200)}, 500: 501.0}


FEATURE_SCHEMA = "series_id string, d date, price double"


def _features(filled):
    from tidemark.operators.series import lags, rolling

    return rolling(lags(filled, "price", (1, 7)), "price", {"mean5": (5, "mean")}, 1)


def test_features_follow_late_corrected_and_new_days(spark, paths, monkeypatch):
    from tidemark.operators.fill import ffill
    from tidemark.operators.series import densify

    d = lambda n: dt.date(2023, 1, 1) + dt.timedelta(n)
    batches = [
        [("a", d(n), float(n)) for n in range(0, 60, 2)] + [("b", d(n), 1.0) for n in (0, 5, 200, 400)],
        [("a", d(21), 500.0), ("a", d(30), -1.0), ("b", d(100), 7.0)],  # late and corrected
        [("a", d(75), 9.0), ("c", d(3), 4.0)],  # new, with a hole before it
        [("a", d(-9), 8.0), ("b", d(402), 2.0), ("b", d(401), None)],  # before all others; a known day without a value
        [("a", d(61), 3.0)],  # into the hole
    ]
    target, held = paths["target"], {}
    read = []

    def spied(*given, build=loads.read_snapshot):
        read.append(build(*given))
        return read[-1]

    monkeypatch.setattr(loads, "read_snapshot", spied)
    for rows in batches:
        read.clear()
        loads.recompute(spark.createDataFrame(rows, FEATURE_SCHEMA), target, "price", _features, 7)
        held.update({(s, day): v for s, day, v in rows})
        full = _features(ffill(densify(spark.createDataFrame([(*k, v) for k, v in held.items()], FEATURE_SCHEMA)), ["price"]))
        got = snapshots.read_snapshot(spark, f"{target}/features", loads.with_months(full).schema).drop("month")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    # The last batch changes days of March 2023: series b's files of 2024 are not read.
    used = {f.split("_place=")[1].split("/")[0] for df in read[1:] for f in df.inputFiles() if len(read) > 1 and "/days/" not in f}
    months = {r[0] for r in loads.with_months(spark.createDataFrame([(d(m),) for m in (45, 61, 75, 82)], "d date")).select(snapshots._place("month")).collect()}
    assert used and used <= months
