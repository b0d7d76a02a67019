"""The given tables in the roles of the daily sources.

lineitem with part gives quotes keyed by brand, orders give the market-wide daily and
monthly rates and the risk events, lineitem by return flag stands in for weather
stations. Every role projects the columns it needs before anything else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.events import daily_event_risk
from tidemark.operators.shaping import daily_agg, widen_locations
from tidemark.plans.dataset import PRICE, SUPPLY, base_dataset, clean_weather

RISK_WEIGHTS = {"AFRICA": 0.15, "AMERICA": 0.40, "ASIA": 0.25, "EUROPE": 0.20}
STATIONS = ("A", "N", "R")


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read with its known schema (no job to infer it)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series_id, d, price, qty)``, one row per line item."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.to_date("l_shipdate").alias("d"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("qty"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("series_id"))
    return items.join(parts, items.l_partkey == parts.p_partkey).select("series_id", "d", "price", "qty")


def daily_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and supply of a day come from the same rows, so one aggregation serves both."""
    measures = {PRICE: ("price", "mean"), SUPPLY: ("qty", "sum0")}
    return daily_agg(quotes(spark, sf_dir), measures).where(F.col(PRICE).isNotNull())


def daily_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-wide rate, one row per day with orders."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), "o_totalprice")
    return daily_agg(orders, {"USD_TO_NPR": ("o_totalprice", "mean")}, keys=())


def step_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value that changes on days with urgent orders."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    orders = orders.select(F.to_date("o_orderdate").alias("d"), "o_totalprice")
    return daily_agg(orders, {"Diesel": ("o_totalprice", "max")}, keys=())


def monthly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per month, dated the first."""
    orders = table(spark, sf_dir, "orders")
    orders = orders.select(F.trunc(F.to_date("o_orderdate"), "month").alias("d"), "o_totalprice")
    return daily_agg(orders, {"Inflation": ("o_totalprice", "mean")}, keys=())


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rate, step changes and monthly rate from one scan, one row per day with any of them.

    Each day's sums count once for the day and once for the first of its month; only these are grouped again.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("d"),
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("urgent"),
    )
    daily = orders.where(F.col("d").isNotNull()).groupBy("d").agg(
        F.sum("o_totalprice").alias("sum"), F.count("o_totalprice").alias("n"), F.max("urgent").alias("urgent")
    )
    of_month = F.struct(
        F.trunc("d", "month").alias("d"), F.lit(None).cast("double").alias("sum"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast("double").alias("urgent"), F.col("sum").alias("month_sum"), F.col("n").alias("month_n"),
    )
    of_day = F.struct("d", "sum", "n", "urgent", F.lit(None).cast("double").alias("month_sum"), F.lit(None).cast("long").alias("month_n"))
    rows = daily.select(F.explode(F.array(of_day, of_month)).alias("_l")).select("_l.*")
    return rows.groupBy("d").agg(
        F.try_divide(F.sum("sum"), F.sum("n")).alias("USD_TO_NPR"),
        F.max("urgent").alias("Diesel"),
        F.try_divide(F.sum("month_sum"), F.sum("month_n")).alias("Inflation"),
    )


def stations_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(location, d, Temperature, Rainfall_MM)``."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("location"), F.to_date("l_shipdate").alias("d"), "l_discount", "l_tax"
    )
    daily = items.groupBy("location", "d").agg(
        (F.avg("l_discount") * 100).alias("Temperature"), F.sum("l_tax").alias("Rainfall_MM")
    )
    return daily.where(F.col("d").isNotNull())


def stations_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widen_locations(stations_long(spark, sf_dir), "location", STATIONS, ["Temperature", "Rainfall_MM"])


def risk_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Date, District, Event_Type, Severity)`` from orders with the region of the customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.to_date("o_orderdate").alias("Date"),
            F.col("r_name").alias("District"),
            F.col("o_orderstatus").alias("Event_Type"),
            (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("Severity"),
        )
    )


def event_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_event_risk(risk_events(spark, sf_dir), RISK_WEIGHTS)


def base_table(spark: SparkSession, sf_dir: str, variant: str = "cloud") -> DataFrame:
    others = [
        market(spark, sf_dir),
        clean_weather(stations_wide(spark, sf_dir), variant=variant),
        event_risk(spark, sf_dir),
    ]
    return base_dataset(daily_quotes(spark, sf_dir), others, variant)
