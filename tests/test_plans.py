"""The plans we want, checked on the plans we get."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from tidemark.operators import evaluate, shaping
from tidemark.plans import catalog, dataset, modelling, roles
from tidemark.plans.dataset import PRICE
from tidemark.sources import increments
from tidemark.session import scratch_path, settle, shared_root


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_stage_of_the_flagship_has_one_exchange(spark):
    text = plan(catalog.queries()["ts_dataset"](spark, TESTDATA))
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+, \d+\)", text)) == 1
    assert len(re.findall(r"Sort \[series_id", text)) == 3  # densify, look ahead, look back


def test_scan_reads_only_needed_columns(spark):
    text = plan(dataset.daily_price(roles.quotes(spark, TESTDATA), "price"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any(set(re.findall(r"(\w+):", s)) == {"l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"} for s in schemas)
    assert any(set(re.findall(r"(\w+):", s)) == {"p_partkey", "p_brand"} for s in schemas)


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(dataset.daily_price(roles.quotes(spark, TESTDATA), "price"))
    exchange = text.index("Exchange hashpartitioning(series_id")
    assert "partial_avg" in text[exchange:] and "partial_avg" not in text[:exchange]


def test_upsert_and_top_k_limit_groups_before_the_shuffle(spark):
    orders = roles.table(spark, TESTDATA, "orders")
    for df in (
        increments.upsert(orders, orders, ["o_orderkey"], "last"),
        increments.dedupe_by(orders, ["o_custkey"], ["o_orderkey"]),
        shaping.top_k_per_group(orders, ["o_orderstatus"], "o_totalprice", 5, ["o_orderkey"]),
    ):
        text = plan(df)
        assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit"), text


def test_top_k_does_not_sort_everything(spark):
    text = plan(shaping.top_k(roles.table(spark, TESTDATA, "orders"), "o_totalprice", 5, ["o_orderkey"]))
    assert "TakeOrderedAndProject" in text


def test_series_filter_reaches_the_scan(spark):
    df = catalog.queries()["price_lags"](spark, TESTDATA).where(F.col("series_id") == "Brand#1")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(p_brand,Brand#1\)", plan(df))


def test_persistence_needs_one_exchange_by_series(spark):
    daily = settle(roles.daily_quotes(spark, TESTDATA).select("series_id", "d", PRICE))
    text = plan(modelling.persistence(daily))
    assert text.count("Exchange") == 1


def test_auc_spreads_one_hot_group(spark):
    df = spark.range(20_000).select((F.col("id") >= 0).cast("string").alias("k"), F.rand(1).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    text = plan(evaluate.grouped_auc(df, "s", "y", ["k"], 8))
    assert "rangepartitioning(k" in text
    assert re.search(r"Window \[sum\(_neg#\d+L\).*windowspecdefinition\(k#\d+, _part#\d+", text)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/") or spark.conf.get("spark.checkpoint.dir") in shared_root(spark)
    text = plan(settle(spark.range(3).withColumn("x", F.lit(1))).select("id"))
    assert shared_root(spark) in text and "ReadSchema: struct<id:bigint>" in text


def test_a_persisted_batch_reads_only_the_partitions_it_touches(spark):
    target = scratch_path(spark, "pruned")
    spark.range(200).select("id", (F.col("id") % 20).cast("int").alias("part")).write.partitionBy("part").parquet(target)
    batch = spark.range(2).select("id", F.lit(3).alias("part")).persist()
    try:
        old = spark.read.schema("id long, part int").parquet(target)
        found = increments.touched_rows(old, batch, "part")
        assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = 3", plan(found))
        assert len(found.inputFiles()) and found.count() == 10
        files = {r[0].rsplit("/", 2)[1] for r in found.select(F.input_file_name()).distinct().collect()}
        assert files == {"part=3"}
    finally:
        batch.unpersist()


def test_joins_of_daily_tables_carry_no_hint(spark):
    df = catalog.queries()["merge_sources"](spark, TESTDATA)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_base_table_reads_orders_twice(spark):
    text = plan(roles.base_table(spark, TESTDATA))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sum("o_orderdate" in s for s in schemas) == 2  # market, and events with the customers' regions
    assert sum("l_shipdate" in s for s in schemas) == 2  # quotes by brand, and stations
