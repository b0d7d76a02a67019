"""Payloads, pages and keyword rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators import events
from tidemark.operators.series import month_windows
from tidemark.plans import roles
from tidemark.plans.catalog.registry import query
from tidemark.sources import payloads
from tidemark.sources.increments import dedupe_by

# Words that occur in the given texts, in the places of place and event names.
PLACES = {"tion": "Tion", "reble": "Reble", "eaux": "Eaux", "rebleed": "Reble"}
GROUPS = {"Slide": ("the then", "andin"), "Water": ("ement", "ción"), "Road": ("ing ", "ung"), "Rain": ("er ",)}
TIERS = {2: ("ent", "and "), 3: ("ation", "heit"), 4: ("theron",), 5: ("ouè", "ßst")}


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(low, '{w}')" for w in words) + ")"


_PLACE = "CASE " + " ".join(f"WHEN contains(low, '{k}') THEN '{v}'" for k, v in PLACES.items()) + " END"
_GROUP = "CASE " + " ".join(f"WHEN {_any(w)} THEN '{g}'" for g, w in GROUPS.items()) + " END"
_TIER = "CASE " + " ".join(f"WHEN {_any(TIERS[t])} THEN {t}" for t in (5, 4, 3, 2)) + " ELSE 1 END"
_LOW = "(SELECT *, lower(text) AS low FROM documents)"
_VOCAB = {"places": PLACES, "groups": GROUPS, "tiers": TIERS}


def _tagged(spark, sf):
    docs = roles.table(spark, sf, "documents").select("doc_id", "text")
    return events.tag_text(docs, F.col("text"), **_VOCAB).drop("text")


@query("detect_first_match", f"SELECT doc_id, {_PLACE} AS district FROM {_LOW}")
def _(spark, sf):
    return _tagged(spark, sf).select("doc_id", "district")


@query("detect_event_type", f"SELECT doc_id, {_GROUP} AS event_type FROM {_LOW}")
def _(spark, sf):
    return _tagged(spark, sf).select("doc_id", "event_type")


@query("severity_score", f"SELECT doc_id, CASE WHEN {_GROUP} IS NOT NULL THEN {_TIER} END AS severity FROM {_LOW}")
def _(spark, sf):
    return _tagged(spark, sf).select("doc_id", "severity")


def _items(spark, sf):
    docs = roles.table(spark, sf, "documents")
    published = F.timestamp_add("HOUR", F.col("doc_id"), F.lit("2022-01-01 00:00:00").cast("timestamp_ntz"))
    return docs.select(
        F.col("text").alias("title"), F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        "source", published.alias("published_at"),
    )


_RECORDS = f"""SELECT CAST(TIMESTAMP '2022-01-01' + to_hours(CAST(doc_id AS INTEGER)) AS DATE) AS date,
  TIMESTAMP '2022-01-01' + to_hours(CAST(doc_id AS INTEGER)) AS published_at, source, text AS title,
  'doc/' || doc_id AS url, {_PLACE} AS district, {_GROUP} AS event_type,
  CASE WHEN {_GROUP} IS NOT NULL THEN {_TIER} END AS severity,
  DATE '2022-01-01' AS window_start, DATE '2022-01-31' AS window_end FROM {_LOW}"""


@query("news_records", _RECORDS)
def _(spark, sf):
    return events.news_records(_items(spark, sf), "2022-01-01", "2022-02-01", **_VOCAB)


@query("district_events", f"""SELECT date AS "Date", district AS "District", event_type AS "Event_Type", severity AS "Severity"
  FROM ({_RECORDS}) WHERE district IN ('Tion', 'Eaux') AND event_type IS NOT NULL AND severity IS NOT NULL""")
def _(spark, sf):
    records = events.news_records(_items(spark, sf), "2022-01-01", "2022-02-01", **_VOCAB)
    return events.district_events(records, ["Tion", "Eaux"])


@query("news_dedupe", """SELECT doc_id, text, source FROM documents
  QUALIFY row_number() OVER (PARTITION BY text, source ORDER BY doc_id) = 1""")
def _(spark, sf):
    docs = roles.table(spark, sf, "documents").select("doc_id", "text", "source")
    return dedupe_by(docs, ["text", "source"], ["doc_id"])


_QUERY_WORDS = " OR ".join(f'"{w}"' for w in events.sorted_vocabulary(fixed.EVENT_WORDS))
_QUERY_PLACES = " OR ".join(f'"{p}"' for p in fixed.PLACE_NAMES)


@query("keyword_query", f"""WITH m AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders),
  w AS (SELECT b, CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS window_start FROM m),
  s AS (SELECT window_start, least(CAST(window_start + INTERVAL 1 MONTH AS DATE), b + 1) AS window_stop FROM w)
  SELECT window_start, '({_QUERY_PLACES}) ({_QUERY_WORDS}) (site:a.example OR site:b.example) Nepal after:' ||
    strftime(window_start, '%Y-%m-%d') || ' before:' || strftime(window_stop, '%Y-%m-%d') AS query FROM s""")
def _(spark, sf):
    span = roles.table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end")
    )
    sites = ("a.example", "b.example")
    return events.keyword_query(month_windows(span), sites=sites).select("window_start", "query")


# --- payloads, built row by row from the given tables ------------------------
@query("json_columns_to_rows", """SELECT o_orderkey, CAST(o_orderdate AS DATE) + k AS d,
    CASE WHEN k = 1 THEN o_totalprice / 2 ELSE (o_totalprice + k + o_totalprice / 2) / 2 END AS "Temperature",
    CASE k WHEN 0 THEN o_totalprice END AS "Air_Pressure", o_totalprice * k AS "Wind_Speed",
    CAST(k AS DOUBLE) AS "Precipitation", CAST(k AS DOUBLE) AS "Rainfall_MM"
  FROM orders CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE o_orderpriority <> '5-LOW'""",
       "Temperature Air_Pressure Wind_Speed Precipitation Rainfall_MM")
def _(spark, sf):
    price, none = F.col("o_totalprice"), F.lit(None).cast("double")
    day = F.to_date("o_orderdate")
    daily = F.struct(
        F.array(*[F.date_format(F.date_add(day, k), "yyyy-MM-dd") for k in range(3)]).alias("time"),
        F.array(price, none, price + 2).alias("temperature_2m_max"),
        F.array(*[price / 2] * 3).alias("temperature_2m_min"),
        F.array(price, none, none).alias("surface_pressure_max"),
        F.array(none, none, none).alias("surface_pressure_min"),
        F.array(price * 0, price, price * 2).alias("wind_speed_10m_max"),
        F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0)).alias("precipitation_sum"),
    )
    options = {"ignoreNullFields": "false"}
    body = F.when(F.col("o_orderpriority") == "5-LOW", F.lit('{"error": true}')).otherwise(
        F.to_json(F.struct(daily.alias("daily")), options)
    )
    rows = roles.table(spark, sf, "orders").select("o_orderkey", body.alias("payload"))
    return payloads.weather_rows(rows, "payload", "o_orderkey")


@query("rss_items", """SELECT o_orderkey, 'Order & ' || o_orderpriority AS title, 'http://x.example/' || o_orderkey || '?a=1&b=2' AS url,
    'desk ' || o_orderstatus AS source, o_orderdate + INTERVAL 75 MINUTE AS published_at FROM orders
  UNION ALL SELECT o_orderkey, 'Late <' || o_orderstatus || '>', '', '', NULL FROM orders""")
def _(spark, sf):
    zone = F.lit(" +0545")
    local = F.timestamp_add("MINUTE", F.lit(75 + 345), F.col("o_orderdate"))
    stamp = F.concat(F.date_format(local, "EEE, dd MMM yyyy HH:mm:ss"), zone)
    xml = F.concat(
        F.lit("<rss version='2.0'><channel><title>feed</title><item><title> Order &amp; "), "o_orderpriority",
        F.lit(" </title><link>http://x.example/"), F.col("o_orderkey").cast("string"), F.lit("?a=1&amp;b=2</link><pubDate>"), stamp,
        F.lit("</pubDate><source url='http://s.example'>desk "), "o_orderstatus",
        F.lit("</source></item><item><title>Late &lt;"), "o_orderstatus",
        F.lit("&gt;</title><pubDate>yesterday</pubDate></item></channel></rss>"),
    )
    feeds = roles.table(spark, sf, "orders").select("o_orderkey", xml.alias("xml"))
    return payloads.explode_rss(feeds, "xml", ["o_orderkey"]).drop("pub_date_raw")


def _dealt(rows):
    """Short rows of a file that one task reads, for as many tasks as there are cores: parsing a page costs far more than moving its key."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _price_pages(spark, sf):
    """One page per order: a decoy date column, an older product column and rows to be skipped."""
    day = F.to_date("o_orderdate")
    other = F.concat((F.year(day) + 57).cast("string"), F.date_format(day, ".M.d"))

    def row(*cells):
        return F.concat(F.lit("<tr class='r'>"), *[x for c in cells for x in (F.lit("<td align=left> "), c, F.lit(" </td>"))], F.lit("</tr>\n"))

    price = F.format_number("o_totalprice", 2)
    page = F.concat(
        F.lit("<html><body><p>list</p><TABLE id='t'><tr><th>No</th><th>Effective <b>Date</b></th><th>Update date</th>"
              "<th>Diesel (old)</th><th>HSD</th></tr>"),
        row(F.lit("1"), F.concat(other, F.date_format(day, "'('yyyy.MM.dd')'")), F.lit("x"), F.lit("1.0"), F.concat(F.lit("<i>"), price, F.lit("</i>"))),
        row(F.lit("2"), F.date_format(F.date_add(day, 1), "yyyy-MM-dd"), F.lit("x"), F.lit("2.0"), F.lit("n/a")),
        row(F.lit("3"), other, F.lit("x"), F.lit("3.0"), F.lit("5")),
        F.lit("<tr><td>short</td></tr>"),
        row(F.lit("4"), F.date_format(F.date_add(day, 2), "yyyy/M/d"), F.lit(""), F.lit("4.0"), F.col("o_orderkey").cast("string")),
        F.lit("</TABLE><table><tr><td>date</td><td>hsd</td></tr><tr><td>1999-01-01</td><td>1</td></tr></table></body></html>"),
    )
    return _dealt(roles.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")).select("o_orderkey", page.alias("html"))


@query("html_table_rows", """SELECT o_orderkey, 1 AS row_no, CAST(o_orderdate AS DATE) AS d, o_totalprice AS value FROM orders
  UNION ALL SELECT o_orderkey, 5, CAST(o_orderdate AS DATE) + 2, CAST(o_orderkey AS DOUBLE) FROM orders""", "value")
def _(spark, sf):
    rows = payloads.explode_html_table(_price_pages(spark, sf), "html", ["o_orderkey"])
    return payloads.dated_values(rows, keep=["o_orderkey"])


@query("scraped_rows", """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS "Date", k AS row_no,
    CASE k WHEN 1 THEN o_orderpriority ELSE 'गोलभेडा (' || o_orderstatus || ')' END AS commodity,
    CASE k WHEN 1 THEN CAST(o_custkey AS VARCHAR) END AS price
  FROM orders CROSS JOIN (SELECT unnest([1, 3]) AS k)""")
def _(spark, sf):
    page = F.concat(
        F.lit("<table><tr><th>a</th><th>b</th></tr><tr><td>"), "o_orderpriority", F.lit("</td><td> "),
        F.col("o_custkey").cast("string"), F.lit("</td></tr><tr><th>none</th></tr><tr><td>गोलभेडा ("), "o_orderstatus",
        F.lit(")</td></tr></table>"),
    )
    rows = roles.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), page.alias("html"))
    return payloads.scraped_rows(rows, "html", "day", ["commodity", "price"], ["o_orderkey"])


# The entities that the given pages have, spelt out here.
_DECODE = "t"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    _DECODE = f"replace({_DECODE}, '{_entity}', '{_char}')"
_TRIM = "trim({x}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


# Behind the last end of a paragraph, one begins at each tag and ends where a block begins or ends.
_BLOCK = "</?(?:article|aside|blockquote|body|dd|div|fieldset|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|pre|section|table|td|th|ul)>"


@query("page_text", f"""WITH b AS (SELECT page_id, regexp_replace(regexp_replace(html,
      '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', ' ', 'g'), '<p\\s[^>]*>', '<p>', 'g') AS body FROM pages),
  h AS (SELECT page_id, body, length(body) - coalesce(nullif(strpos(reverse(body), '>p/<'), 0) - 1, length(body)) AS cut FROM b),
  p AS (SELECT page_id, list_concat(
      regexp_extract_all(substr(body, 1, cut), '(?is)<p>(.*?)</p>', 1),
      list_transform(string_split(substr(body, cut + 1), '<p>')[2:], lambda x: regexp_replace(x, '(?is){_BLOCK}.*$', ''))) AS ps FROM h),
  n AS (SELECT page_id, list_transform(ps, lambda f: array_to_string(list_filter(
      list_transform(string_split_regex(f, '<[^>]*>'), lambda x: {_TRIM.format(x='x')}), lambda y: y <> ''), ' ')) AS ts FROM p),
  u AS (SELECT page_id, list_filter(list_transform(ts, lambda t: {_DECODE}), lambda z: length(z) > 30) AS ts FROM n)
  SELECT page_id, coalesce(trim(regexp_replace(array_to_string(ts, ' '), '\\s+', ' ', 'g')), '') AS text FROM u""")
def _(spark, sf):
    return roles.table(spark, sf, "pages").select("page_id", payloads.page_text(F.col("html")).alias("text"))
