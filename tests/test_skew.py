"""One key owns a third of the rows: results stay whole and no task is handed the key's raw rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import report, shaping
from tidemark.sources import increments, sheets

N = 60_000


@pytest.fixture(scope="module")
def rows(spark):
    """Series 0 owns a third of the rows; the days repeat, so daily grain is far smaller."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400 + 1)
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 7 % 50).cast("int"))
    return spark.range(0, N, 1, 16).select(
        key.cast("string").alias("series_id"), day.alias("d"), (F.col("id") % 101).cast("double").alias("x"), F.col("id").alias("seq")
    ).cache()


def test_daily_grain_of_a_hot_key(rows):
    daily = shaping.daily_agg(rows, {"n": ("x", "sum0")})
    assert daily.agg(F.sum("n")).first()[0] == rows.agg(F.sum("x")).first()[0]
    assert daily.where("series_id = '0'").count() == 50
    pdf = rows.where("series_id = '0'").toPandas()
    want = pdf.groupby("d")["x"].sum().to_dict()
    assert {r["d"]: r["n"] for r in daily.where("series_id = '0'").collect()} == want


def test_upsert_of_a_hot_key_ships_one_row_per_task(rows):
    out = increments.upsert(rows, rows.withColumn("x", F.col("x") + 1000), ["series_id"], "last", ["seq"])
    got = {r["series_id"]: r["x"] for r in out.collect()}
    want = {r["series_id"]: r["x"] for r in rows.groupBy("series_id").agg((F.max_by("x", "seq") + 1000).alias("x")).collect()}
    assert got == want


def test_quality_report_of_a_hot_row(rows):
    twice = rows.drop("seq").withColumn("d", F.to_date(F.lit("2024-01-01"))).withColumn("x", F.lit(1.0))
    got = {r["item"]: r["value"] for r in report.quality_report(twice).collect()}
    distinct = twice.distinct().count()
    assert got["rows"] == str(N) and got["repeated_rows"] == str(N - distinct)


def test_long_sheet_is_carried_in_blocks(spark):
    n = 20_000
    df = spark.range(n).select(
        F.lit(1).alias("sheet_id"), F.col("id").alias("row_no"), F.when(F.col("id") % 4999 == 7, F.col("id")).alias("label")
    )
    out = sheets.section_carry(df, "label", block=256)
    bad = out.where(~F.col("label").eqNullSafe(F.when(F.col("row_no") >= 7, F.floor((F.col("row_no") - 7) / 4999) * 4999 + 7)))
    assert out.count() == n and bad.count() == 0
