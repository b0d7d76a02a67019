"""Readers, cleaning functions, upserts and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates, numbers
from tidemark.operators import series, shaping
from tidemark.plans import dataset, roles
from tidemark.plans.catalog.registry import query
from tidemark.session import scratch_path
from tidemark.sources import increments, sheets, tables


def _orders(spark, sf, *cols):
    return roles.table(spark, sf, "orders").select(*cols)


@query("scan_csv_roundtrip", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS d, o_orderpriority FROM orders",
       "o_totalprice")
def _(spark, sf):
    rows = _orders(spark, sf, "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("d"), "o_orderpriority")
    path = scratch_path(spark, "csv")
    tables.write_table(rows, path, "csv")
    return tables.read_table(spark, path, rows.schema, "csv", required=True)


@query("drop_if_exists", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def _(spark, sf):
    gone = [*fixed.RATE_METADATA, "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return tables.drop_if_exists(roles.table(spark, sf, "orders"), gone)


@query("drop_nonpositive", """SELECT * FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal - 5000 END AS x
  FROM customer) WHERE x > 0 OR x IS NULL""", "x")
def _(spark, sf):
    x = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") - 5000).alias("x")
    return shaping.drop_nonpositive(roles.table(spark, sf, "customer").select("c_custkey", x), "x")


# --- scraped numbers, names and dates ----------------------------------------
_TEXT_SQL = """CASE o_orderpriority
  WHEN '1-URGENT' THEN 'रू ' || translate(format('{:,.2f}', o_totalprice), '0123456789', '०१२३४५६७८९')
  WHEN '2-HIGH' THEN '  ' || format('{:,.2f}', o_totalprice) || ' '
  WHEN '3-MEDIUM' THEN 'n/a' WHEN '4-NOT SPECIFIED' THEN 'nan' END"""


@query("clean_number", f"""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
  TRY_CAST(translate(trim(replace(replace({_TEXT_SQL}, 'रू', ''), ',', '')), '०१२३४५६७८९', '0123456789') AS DOUBLE) END AS x
  FROM orders""", "x")
def _(spark, sf):
    money = F.format_number("o_totalprice", 2)
    which = F.col("o_orderpriority")
    text = (
        F.when(which == "1-URGENT", F.concat(F.lit("रू "), F.translate(money, "0123456789", fixed.DEVANAGARI_DIGITS)))
        .when(which == "2-HIGH", F.concat(F.lit("  "), money, F.lit(" ")))
        .when(which == "3-MEDIUM", "n/a")
        .when(which == "4-NOT SPECIFIED", "nan")
    )
    rows = _orders(spark, sf, "o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", numbers.clean_number(F.col("t")).alias("x"))


_NAMES = {"small ring": "Ring_Small", "red": "Red_Any", "ring": "Ring", "widget": "Widget"}


@query("normalize_category", """SELECT p_partkey, CASE WHEN contains(p_name, 'small ring') THEN 'Ring_Small'
  WHEN contains(p_name, 'red') THEN 'Red_Any' WHEN contains(p_name, 'ring') THEN 'Ring'
  WHEN contains(p_name, 'widget') THEN 'Widget' ELSE trim(p_name) END AS category FROM part""")
def _(spark, sf):
    name = F.concat(F.col("p_name"), F.lit(" (red "), F.col("p_type"), F.lit(") "))
    return roles.table(spark, sf, "part").select("p_partkey", numbers.normalize_category(name, _NAMES).alias("category"))


@query("parse_dates", """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def _(spark, sf):
    day, which = F.to_date("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(which == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(which == "2-HIGH", F.date_format(day, "MM/dd/yyyy"))
        .when(which == "3-MEDIUM", F.date_format(day, "yyyy/MM/dd"))
        .when(which == "4-NOT SPECIFIED", F.date_format(day, "'31/31/'yyyy"))
    )
    return _orders(spark, sf, "o_orderkey", text.alias("t")).select("o_orderkey", dates.parse_date(F.col("t")).alias("d"))


@query("extract_ad_date", """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def _(spark, sf):
    day, which = F.to_date("o_orderdate"), F.col("o_orderpriority")
    other = F.concat((F.year(day) + 57).cast("string"), F.date_format(day, ".M.d"))
    text = (
        F.when(which == "1-URGENT", F.concat(other, F.date_format(day, "'('yyyy.MM.dd')'")))
        .when(which == "2-HIGH", F.concat(F.date_format(day, "yyyy.MM.dd"), F.lit(" ("), other, F.lit(")")))
        .when(which == "3-MEDIUM", F.concat(F.lit("प्रेस "), other, F.date_format(day, "' ('yyyy-M-d')'")))
        .when(which == "4-NOT SPECIFIED", F.concat(F.lit("1999/13/45 "), F.translate(F.date_format(day, "yyyy/MM/dd"), "0123456789", fixed.DEVANAGARI_DIGITS)))
        .otherwise(other)
    )
    return _orders(spark, sf, "o_orderkey", text.alias("t")).select("o_orderkey", dates.extract_ad_date(F.col("t")).alias("d"))


@query("market_day", "SELECT event_id, CAST(ts + INTERVAL 345 MINUTE AS DATE) AS d FROM events")
def _(spark, sf):
    events = roles.table(spark, sf, "events")
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return events.select("event_id", dates.local_today(instant).alias("d"))


# --- sheets ------------------------------------------------------------------
@query("discover_columns", "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS usd_sell FROM orders", "usd_sell")
def _(spark, sf):
    export = _orders(
        spark, sf, F.col("o_orderpriority").alias("Currency Name"), F.to_date("o_orderdate").alias(" Published Date "),
        (F.col("o_totalprice") * 2).alias("USD Buy"), F.col("o_totalprice").alias("U.S. Dollar Sell"),
    )
    return sheets.rate_rows(export)


@query("sheet_header_seek", """SELECT p_partkey AS sheet_id, CAST(p_size % 4 + 1 + k AS INTEGER) AS row_no,
  p_type || ' ' || k AS label, CAST(p_retailprice + k AS VARCHAR) AS inflation
  FROM part CROSS JOIN (SELECT unnest([0, 1, 2]) AS k)""")
def _(spark, sf):
    part = roles.table(spark, sf, "part")
    blank = F.array(F.lit("Consumer prices"), F.col("p_name"), F.lit(None).cast("string"))
    header = F.array(F.lit("Fiscal Year"), F.lit("Overall Index"), F.lit("% Change"))
    titles = F.transform(F.sequence(F.lit(0), F.col("p_size") % 4), lambda i: blank)
    lines = [
        F.array(F.concat("p_type", F.lit(f" {k}")), F.lit("1"), (F.col("p_retailprice") + k).cast("string")) for k in range(3)
    ]
    rows = F.concat(F.slice(titles, F.lit(1), F.col("p_size") % 4), F.array(header), F.array(*lines))
    cells = part.select(F.col("p_partkey").alias("sheet_id"), F.posexplode(rows).alias("row_no", "cells"))
    below = sheets.seek_header(cells)
    return below.select(
        "sheet_id", "row_no", sheets.cell_under(["fiscal year"]).alias("label"),
        sheets.cell_under(["overall index"], offset=1).alias("inflation"),
    )


_PAIRS = ["Jul/Aug", "Aug/Sep", "Sep/Oct", "Oct/Nov", "Nov/Dec", "Dec/Jan", "Jan/Feb", "Feb/Mar", "Mar/Apr", "Apr/May", "May/Jun", "Jun/Jul"]


@query("fiscal_months", """SELECT s_suppkey AS sheet_id, CAST(make_date(y, 7, 1) + to_months(CAST(k AS INTEGER)) AS DATE) AS d,
  s_acctbal + y + k AS value
  FROM supplier CROSS JOIN (SELECT unnest([2020, 2021, 2022]) AS y) CROSS JOIN (SELECT unnest(range(0, 12)) AS k)
  WHERE k <> s_nationkey % 12""", "value")
def _(spark, sf):
    def year(y: int):
        head = F.struct(F.lit(f"{y}/{(y + 1) % 100:02d} (20{y - 1943}/{(y - 1942) % 100})").alias("raw_date"), F.lit("7.7").alias("raw_value"))
        months = [
            F.struct(
                F.lit(label).alias("raw_date"),
                F.when(F.col("s_nationkey") % 12 == k, "-").otherwise((F.col("s_acctbal") + y + k).cast("string")).alias("raw_value"),
            )
            for k, label in enumerate(_PAIRS)
        ]
        return [head, *months]

    stray = F.struct(F.lit("Jul/Aug").alias("raw_date"), F.lit("1").alias("raw_value"))
    lines = F.array(stray, *year(2020), *year(2021), *year(2022))
    rows = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sheet_id"), F.posexplode(lines).alias("row_no", "_l"))
    return sheets.fiscal_months(rows.select("sheet_id", "row_no", "_l.*"))


# --- increments --------------------------------------------------------------
_OLD = "SELECT event_id, ts, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-16'"
_NEW = "SELECT event_id, ts, event_type, value * 2 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-14'"


def old_new(spark, sf):
    events = roles.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    old = events.where(F.col("ts") < at("2024-01-16 00:00:00"))
    new = events.where(F.col("ts") >= at("2024-01-14 00:00:00")).withColumn("value", F.col("value") * 2)
    return old, new


@query("incremental_new_rows", f"""WITH o AS ({_OLD}), n AS ({_NEW}), m AS (SELECT event_type, max(ts) AS m FROM o GROUP BY 1)
  SELECT n.* FROM n LEFT JOIN m USING (event_type) WHERE ts > coalesce(m, TIMESTAMP '2021-12-31')""", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    return increments.new_rows(new, old, ["event_type"], "ts")


@query("incremental_new_rows_table", f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT * FROM n WHERE ts > (SELECT max(ts) FROM o)", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    return increments.new_rows(new, old, (), "ts")


@query("upsert_keep_first", f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT * FROM o UNION ALL SELECT * FROM n ANTI JOIN o USING (event_id)", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    return increments.upsert(old, new, ["event_id"], "first", ["ts"])


@query("upsert_keep_last", f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT * FROM n UNION ALL SELECT * FROM o ANTI JOIN n USING (event_id)", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    return increments.upsert(old, new, ["event_id"], "last", ["ts"])


@query("append_all", f"WITH o AS ({_OLD}), n AS ({_NEW}) SELECT * FROM o UNION ALL SELECT * FROM n", "value")
def _(spark, sf):
    old, new = old_new(spark, sf)
    return increments.append(old, new)


@query("dedupe_rows", "SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS d FROM lineitem")
def _(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.col("l_shipdate").alias("d"))
    return increments.dedupe(rows, ["d"])


def _dedupe_query(name: str, keep: str, direction: str):
    @query(name, f"""SELECT d, o_orderkey, o_totalprice FROM (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey, o_totalprice,
      row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey {direction}) AS rn FROM orders) WHERE rn = 1""",
           "o_totalprice")
    def _(spark, sf):
        rows = _orders(spark, sf, F.to_date("o_orderdate").alias("d"), "o_orderkey", "o_totalprice")
        return increments.dedupe_by(rows, ["d"], ["o_orderkey"], keep)


_dedupe_query("dedupe_by_date", "first", "ASC")
_dedupe_query("dedupe_by_date_last", "last", "DESC")


@query("macro_rows", """SELECT d, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS "Diesel" FROM (
  SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice, o_orderpriority,
    row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn FROM orders
  WHERE o_orderpriority <> '3-MEDIUM') WHERE rn = 1""", "Diesel")
def _(spark, sf):
    which = F.col("o_orderpriority")
    raw = _orders(
        spark, sf, "o_orderkey",
        F.when(which == "3-MEDIUM", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(which == "5-LOW", "-").otherwise(F.col("o_totalprice").cast("string")).alias("diesel"),
    )
    return dataset.macro_rows(raw, "date", "diesel", "Diesel", ["o_orderkey"])


@query("common_dates", """SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem
  SEMI JOIN (SELECT DISTINCT o_orderdate::DATE AS od FROM orders WHERE o_orderpriority = '1-URGENT') ON l_shipdate::DATE = od""")
def _(spark, sf):
    days = roles.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()
    return shaping.common_dates(days, roles.step_changes(spark, sf), ["d"])


@query("require_unique_days", "SELECT CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS \"USD_TO_NPR\" FROM orders GROUP BY 1", "USD_TO_NPR")
def _(spark, sf):
    return series.unique_by(roles.daily_rate(spark, sf), ["d"])
