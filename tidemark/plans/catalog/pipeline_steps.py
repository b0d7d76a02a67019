"""Steps of the daily load from raw rows on: quotes and volumes, rate sheets, news with bodies, lossy text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import dates
from tidemark.operators import events
from tidemark.plans import dataset, roles
from tidemark.plans.catalog.registry import query
from tidemark.plans.catalog.text import _GROUP, _PLACE, GROUPS, PLACES
from tidemark.session import scratch_path
from tidemark.sources import sheets, tables
from tidemark.streaming import loads

# --- raw market rows: local digits, currency sign, commas, remarks in brackets, three ways to write a day
_NAMES = ("गोलभेडा ठूलो(नेपाली)", "गोलभेडा सानो (लोकल)", " गोलभेडा ", "आलु रातो")
_KEPT_SQL = "CASE p_size % 4 WHEN 0 THEN 'Tomato_Big' WHEN 1 THEN 'Tomato_Small' WHEN 2 THEN 'Tomato' END"
_RAW_SQL = f"""raw AS (SELECT {_KEPT_SQL} AS series_id, CAST(l_shipdate AS DATE) AS d, l_quantity,
  CASE WHEN l_linenumber <> 4 THEN round(l_quantity * 1000 + 0.5, 1) END AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size % 4 < 3 AND l_linenumber <> 5)"""


def _raw_rows(spark, sf, value, column):
    items = roles.table(spark, sf, "lineitem").select("l_partkey", "l_linenumber", "l_shipdate", "l_quantity")
    parts = roles.table(spark, sf, "part").select("p_partkey", "p_size")
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("p_size") % 4 + 1).cast("int"))
    day = F.to_date("l_shipdate")
    written = (
        F.when(F.col("l_linenumber") == 1, F.date_format(day, "M/d/yyyy")).when(F.col("l_linenumber") == 2, F.date_format(day, "yyyy-MM-dd'T00:00:00'"))
        .when(F.col("l_linenumber") == 5, F.lit("not a day")).otherwise(F.date_format(day, "MM/dd/yyyy"))
    )
    rows = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(written.alias("Date"), name.alias("कृषि उपज"), value.alias(column))


@query("raw_quotes_daily", f"""WITH {_RAW_SQL} SELECT series_id, d, avg(price) AS "Average_Price" FROM raw
  WHERE d IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2""", "Average_Price")
def _(spark, sf):
    text = F.translate(F.format_number(F.col("l_quantity") * 1000 + 0.5, 1), "0123456789", fixed.DEVANAGARI_DIGITS)
    price = F.when(F.col("l_linenumber") == 4, F.lit("-")).otherwise(F.concat(F.lit("रू "), text))
    quotes = dataset.quote_rows(_raw_rows(spark, sf, price, "औसत"))
    return dataset.daily_price(quotes.withColumnRenamed("commodity", "series_id"))


@query("raw_volumes_daily", f"""WITH {_RAW_SQL} SELECT series_id, d, coalesce(sum(l_quantity), 0) AS "Supply_Volume" FROM raw
  WHERE d IS NOT NULL GROUP BY 1, 2""", "Supply_Volume")
def _(spark, sf):
    volume = F.translate(F.col("l_quantity").cast("string"), "0123456789", fixed.DEVANAGARI_DIGITS)
    rows = dataset.quote_rows(_raw_rows(spark, sf, volume, "आगमन"), fixed.SUPPLY_COLUMNS)
    return dataset.daily_supply(rows.withColumnRenamed("commodity", "series_id"))


# --- a rate sheet of unknown layout, one per supplier; the header stands as far down as the nation says
@query("sheet_inflation", """SELECT s_suppkey AS sheet_id, CAST(make_date(2021, 7, 1) + to_months(CAST(k AS INTEGER)) AS DATE) AS d,
  s_acctbal + k AS value FROM supplier CROSS JOIN (SELECT unnest(range(0, 12)) AS k) WHERE k <> s_nationkey % 12""", "value")
def _(spark, sf):
    def line(*cells):
        return F.array(*[c if not isinstance(c, str) else F.lit(c) for c in cells])

    title = line("Consumer prices", " ", "all items")
    header = line("No", "Mid-Month", "% Change")
    months = [
        line(str(k), label.title(), F.when(F.col("s_nationkey") % 12 == k, "...").otherwise((F.col("s_acctbal") + k).cast("string")))
        for k, label in enumerate(fixed.MONTH_PAIRS)
    ]
    titles = F.transform(F.sequence(F.lit(0), F.col("s_nationkey")), lambda i: title)
    rows = F.concat(titles, F.array(header, line("0", "2021/22 (2078/79)", "")), F.array(*months))
    cells = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sheet_id"), F.posexplode(rows).alias("row_no", "cells"))
    return sheets.inflation_rows(cells)


# --- news with title and body, and the longer list of severity words
_LOCAL_TIER = "CASE " + " ".join(
    "WHEN (" + " OR ".join(f"contains(low, '{w}')" for w in fixed.SEVERITY_WORDS_LOCAL[t]) + f") THEN {t}" for t in (5, 4, 3, 2)
) + " ELSE 1 END"


@query("news_records_local", f"""SELECT DATE '2022-01-01' + CAST(doc_id // 24 AS INTEGER) AS date, 'doc/' || doc_id AS url, {_PLACE} AS district,
  {_GROUP} AS event_type, CASE WHEN {_GROUP} IS NOT NULL THEN {_LOCAL_TIER} END AS severity
  FROM (SELECT doc_id, lower(source || ' ' || text || CASE WHEN doc_id % 3 = 0 THEN ' power supply disrupted' WHEN doc_id % 7 = 0 THEN ' death toll' ELSE '' END) AS low
    FROM documents)""")
def _(spark, sf):
    docs = roles.table(spark, sf, "documents")
    published = F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2022-01-01 00:00:00").cast("timestamp_ntz"))
    ending = F.when(F.col("doc_id") % 3 == 0, " power supply disrupted").when(F.col("doc_id") % 7 == 0, " death toll").otherwise("")
    items = docs.select(
        F.col("source").alias("title"), F.concat("text", ending).alias("body"), F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        "source", published.alias("published_at"),
    )
    records = events.news_records(items, "2022-01-01", "2030-01-01", body="body", places=PLACES, groups=GROUPS, tiers=fixed.SEVERITY_WORDS_LOCAL)
    return records.select("date", "url", "district", "event_type", "severity")


# --- days as scraped pages write them
@query("parse_dates_forms", "SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 7 THEN CAST(o_orderdate AS DATE) END AS d FROM orders")
def _(spark, sf):
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 8
    forms = ("M/d/yyyy", "yyyy-M-d", "yyyy-MM-dd'T00:00:00'", "yyyy-MM-dd' 10:20:30.5'", "dd MMM yyyy", "yyyy/M/d", "MMMM d, yyyy")
    text = F.lit("31/31/2020")
    for n, form in enumerate(forms):
        text = F.when(k == n, F.date_format(day, form)).otherwise(text)
    return roles.table(spark, sf, "orders").select("o_orderkey", dates.parse_date(text).alias("d"))


# --- bytes that are no UTF-8 become U+FFFD, the rest of the row is kept
@query("lossy_decode", """SELECT c_custkey, 'a' || chr(65533) || 'b ' || c_mktsegment AS name, c_acctbal FROM customer""", "c_acctbal")
def _(spark, sf):
    rows = roles.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("aéb "), "c_mktsegment").alias("name"), "c_acctbal")
    path = scratch_path(spark, "lossy")
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)  # é is then the single byte E9
    return tables.read_table(spark, path, rows.schema, "csv", required=True)


# --- a feed that repeats items: the first row of each (title, url) stays
@query("stream_dedupe_items", """SELECT title, url, min(event_id) AS event_id FROM (
  SELECT event_id, event_type AS title, 'user/' || user_id AS url FROM events) GROUP BY 1, 2""")
def _(spark, sf):
    given = roles.table(spark, sf, "events").select(
        F.col("event_type").alias("title"), F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("url"), "event_id", "ts"
    )
    source, target, state = (scratch_path(spark, f"items-{x}") for x in ("source", "target", "state"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (given.where(F.col("ts") < cut), given.where(F.col("ts") >= cut)):
        part.write.mode("append").parquet(source)
        loads.stream_first(loads.file_stream(spark, source, given.schema), target, ["title", "url"], state, ["event_id"]).awaitTermination()
    return loads.first_rows(spark, target, given.schema).select("title", "url", "event_id")


@query("unseen_headers", "SELECT s_suppkey AS sheet_id, CAST(2 AS BIGINT) AS n_rows FROM supplier WHERE s_nationkey % 2 = 1")
def _(spark, sf):
    """Sheets in which no header is found, as many as there are."""
    first = F.when(F.col("s_nationkey") % 2 == 0, F.lit("Fiscal Year")).otherwise(F.col("s_name"))
    rows = F.array(F.array(F.lit("1"), F.lit("x")), F.array(first, F.lit("y")))
    cells = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sheet_id"), F.posexplode(rows).alias("row_no", "cells"))
    return sheets.sheets_without_header(cells)
