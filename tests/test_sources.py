from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidemark import fixed
from tidemark.session import scratch_path
from tidemark.sources import increments, payloads, sheets, tables


# --- tables ------------------------------------------------------------------
def test_csv_roundtrip_with_bad_cells_and_bytes(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_bytes("Date,name,x\n2024-01-01,रू,1.5\n2024-01-02,a\xff,oops\n".encode("utf-8").replace("ÿ".encode(), b"\xff"))
    got = [tuple(r) for r in tables.read_table(spark, str(path), "Date date, name string, x double").orderBy("Date").collect()]
    assert got == [(day("2024-01-01"), "रू", 1.5), (day("2024-01-02"), "a�", None)]


def test_nan_is_missing_on_input(spark, tmp_path):
    (tmp_path / "n.csv").write_text("a,b\nNaN,1\n2.5,NaN\n")
    got = [tuple(r) for r in tables.read_table(spark, str(tmp_path / "n.csv"), "a double, b float").collect()]
    assert got == [(None, 1.0), (2.5, None)]


def test_missing_path_gives_an_empty_table_unless_required(spark, tmp_path):
    schema = "a int, b string"
    empty = tables.read_table(spark, str(tmp_path / "nope"), schema)
    assert empty.columns == ["a", "b"] and empty.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, str(tmp_path / "nope"), schema, required=True)


def test_partitioned_write(spark, frame, tmp_path):
    df = tables.with_month(frame("d date, x int", [(day("2024-01-05"), 1), (day("2024-02-01"), 2)]))
    tables.write_table(df, str(tmp_path / "t"), partition_by=["month"])
    back = spark.read.parquet(str(tmp_path / "t")).where(F.col("month") == F.lit("2024-02-01").cast("date"))
    assert [r["x"] for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(month" in back._jdf.queryExecution().toString()


def test_metadata_helpers(frame):
    df = frame("A_Temp int, b int, unit int", [(1, 2, 3)])
    assert tables.drop_if_exists(df, fixed.RATE_METADATA).columns == ["A_Temp", "b"]
    assert tables.columns_containing(df, "temp") == [] and tables.columns_containing(df, "temp", ignore_case=True) == ["A_Temp"]
    with pytest.raises(ValueError, match="missing columns"):
        tables.require_columns(df, ["b", "c"])


# --- sheets ------------------------------------------------------------------
def test_discover_columns():
    assert sheets.discover_column(["x", "day"], fixed.DATE_HEADERS, [("date",)]) == "day"
    assert sheets.discover_column(["the_date_x", "period"], fixed.DATE_HEADERS) == "period"
    assert sheets.discover_column(["a", "the_date_x"], fixed.DATE_HEADERS, [("date",)]) == "the_date_x"
    assert sheets.discover_column(["usd_buy", "sell_usd_x", "sell"], fixed.SELL_HEADERS, [("usd", "sell"), ("sell",)]) == "sell_usd_x"
    assert sheets.any_word_column(["Month", "Overall Index", "% Change"], fixed.SHEET_VALUE_WORDS, after="overall index") == "% Change"
    assert sheets.any_word_column(["Month", "Overall Inflation"], fixed.SHEET_VALUE_WORDS, after="overall index") == "Overall Inflation"
    with pytest.raises(ValueError, match="no matching column"):
        sheets.discover_column(["a"], ["b"])


def test_rate_rows_variants(frame):
    df = frame("Date string, USD string", [("2024-01-01", "133.5")])
    assert sheets.rate_rows(df, "local").columns == ["date", "usd_sell"]
    with pytest.raises(ValueError):
        sheets.rate_rows(df)


def test_seek_header_reads_the_whole_sheet(frame):
    df = frame("sheet_id int, row_no int, cells array<string>", [
        (1, 0, ["Title", None]), (1, 1, ["FISCAL YEAR", "% Change"]), (1, 2, ["2021/22", "7"]),
        (2, 0, ["month", "x"]), (2, 1, ["a", "b"]), (2, 110, ["Mid-Month", "far down"]), (2, 111, ["Jul/Aug", "3"]),
        (3, 0, ["no", "header"]), (3, 1, [None, "at all"]),
    ])
    got = sorted((r["sheet_id"], r["row_no"], r["header"][0], r["cells"][0]) for r in sheets.seek_header(df).collect())
    assert got == [(1, 2, "FISCAL YEAR", "2021/22"), (2, 111, "Mid-Month", "Jul/Aug")]
    assert [tuple(r) for r in sheets.sheets_without_header(df).collect()] == [(3, 2)]


def test_headers_of_many_sheets_are_not_broadcast(spark, tmp_path):
    lines = F.array(F.array(F.lit("title")), F.array(F.lit("Fiscal Year")), F.array(F.col("id").cast("string")))
    spark.range(50).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").select(F.col("id").alias("sheet_id"), F.posexplode(lines).alias("row_no", "cells"))
    got = sheets.seek_header(df)
    assert sorted((r["sheet_id"], r["row_no"], r["cells"][0]) for r in got.collect()) == [(i, 2, str(i)) for i in range(50)]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_inflation_rows(frame):
    lines = [["Prices", None, None, None]] * 12 + [
        ["No", "Mid-Month", "Overall Index", "Change"], ["1", "2021/22", None, None], ["2", "Jul/Aug", "100", "4.5"], ["3", "Jan/Feb", "101", "5"],
    ]
    other = [["Fiscal Year", "Inflation"], ["2022/23", ""], ["Aug/Sep", "7.5"], ["Sep/Oct", "n/a"]]
    df = frame("sheet_id int, row_no int, cells array<string>", [(s, i, c) for s, x in ((1, lines), (2, other)) for i, c in enumerate(x)])
    got = sorted((r["sheet_id"], str(r["d"]), r["value"]) for r in sheets.inflation_rows(df).collect())
    assert got == [(1, "2021-07-01", 4.5), (1, "2022-01-01", 5.0), (2, "2022-08-01", 7.5)]


@pytest.mark.parametrize("block", [2, 3, 4096])
def test_section_carry_over_blocks(frame, block):
    labels = [None, "x", None, None, None, "y", None, None, None, None]
    df = frame("sheet_id int, row_no int, fy string", [(s, i, v) for s in (1, 2) for i, v in enumerate(labels)])
    got = sheets.section_carry(df, "fy", block=block).orderBy("sheet_id", "row_no").collect()
    assert [r["fy"] for r in got] == [None, "x", "x", "x", "x", "y", "y", "y", "y", "y"] * 2


def test_fiscal_months(frame):
    lines = [("Jul/Aug", "1"), ("2021/22", "9"), ("Jul/Aug", "4.1"), ("Dec/Jan", "5"), ("Jan/Feb", "x"), ("Jun/Jul", "6"),
             (None, "3"), ("2022/23 (2079/80)", None), (" jul/aug ", "7"), ("Jul/Aug", "8"), ("Average", "1")]
    df = frame("sheet_id int, row_no int, raw_date string, raw_value string", [(1, i, *x) for i, x in enumerate(lines)])
    got = sorted((str(r["d"]), r["value"]) for r in sheets.fiscal_months(df).collect())
    assert got == [("2021-07-01", 4.1), ("2021-12-01", 5.0), ("2022-06-01", 6.0), ("2022-07-01", 7.0)]


# --- payloads ----------------------------------------------------------------
def test_weather_payload(frame):
    body = ('{"daily":{"time":["2024-01-01","2024-01-02"],"temperature_2m_max":[20.0,null],"temperature_2m_min":[10.0,4.0],'
            '"surface_pressure_max":[900,null],"surface_pressure_min":[800,null],"wind_speed_10m_max":[3,4],"precipitation_sum":[null,1.5]}}')
    df = frame("location string, payload string", [("K", body), ("S", '{"error":true}'), ("T", "broken")])
    got = [tuple(r) for r in payloads.weather_rows(df, "payload").orderBy("d").collect()]
    assert got == [("K", day("2024-01-01"), 15.0, 850.0, 3.0, None, None), ("K", day("2024-01-02"), 4.0, None, 4.0, 1.5, 1.5)]


def test_rss_items(frame):
    xml = ("<rss><channel><title>t</title><item><title> Flood &amp; rain </title><link>http://a</link>"
           "<pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate><source url='u'>S</source></item>"
           "<item><title>x</title><pubDate>bad</pubDate></item></channel></rss>")
    df = frame("id int, x string", [(1, xml), (2, "<rss><channel/></rss>")])
    got = [tuple(r) for r in payloads.explode_rss(df, "x", ["id"]).orderBy("title").collect()]
    assert got == [(1, "Flood & rain", "http://a", "Mon, 01 Jan 2024 10:00:00 GMT", "S", dt.datetime(2024, 1, 1, 10)), (1, "x", "", "bad", "", None)]


def test_html_table(frame):
    page = ("<p>intro</p><table class=x><tr><th>S.N.</th><th>Effective Date</th><th>Date of notice</th><th>Petrol</th><th>Diesel</th><th>HSD (Rs)</th></tr>"
            "<tr><td>1</td><td>2082.12.11<br>(2026.03.26)</td><td>2020-01-01</td><td>1</td><td>2</td><td> 1,234.5 </td></tr>"
            "<tr><td>short</td></tr><tr><th>no cells</th></tr>"
            "<tr><td>2</td><td>2025-01-02</td><td></td><td></td><td>9</td><td>n/a</td></tr>"
            "<tr><td>3</td><td>unknown</td><td></td><td></td><td>9</td><td>5</td></tr>"
            "<tr><td>4</td><td>2025/1/3</td><td></td><td></td><td></td><td>&nbsp;7&nbsp;</td></tr></table>"
            "<table><tr><td>date</td><td>hsd</td></tr><tr><td>2001-01-01</td><td>1</td></tr></table>")
    df = frame("id int, html string", [(1, page), (2, "<p>none</p>"), (3, "<table><tr><td>a</td></tr><tr><td>2001-01-01</td></tr></table>")])
    rows = payloads.explode_html_table(df, "html", ["id"])
    got = sorted(tuple(r) for r in payloads.dated_values(rows, keep=["id"]).collect())
    assert got[0] == (1, 1, day("2026-03-26"), 1234.5) and got[1][:3] == (1, 6, day("2025-01-03"))
    assert {r["id"] for r in rows.collect()} == {1, 3} and len(got) == 2


def test_page_text(frame):
    long, other = "A sentence that is long enough to stay.", "Another sentence which is long enough, too."
    html = (f"<html><script>var x='<p>{long}</p>';</script><pre>no</pre><p class='a'>{long}</p><p>short one</p>"
            f"<P>Another <b>sentence</b> which\n is <i>long enough, </i>too.</P></html>")
    df = frame("html string", [(html,), ("",)])
    text = [r[0] for r in df.select(payloads.page_text(F.col("html"))).collect()]
    assert text == [f"{long} {other}", ""]
    assert df.select(payloads.page_text(F.col("html"), max_len=9)).first()[0] == long[:9]


def test_page_text_is_whole_unless_a_cut_is_asked_for(frame):
    df = frame("html string", [("".join(f"<p>{i:05d} {'word ' * 20}</p>" for i in range(400)),)])
    whole, cut = df.select(payloads.page_text(F.col("html")), payloads.page_text(F.col("html"), max_len=20_000)).first()
    assert len(whole) > 40_000 and cut == whole[:20_000]


def test_any_number_of_tags_in_a_paragraph(frame):
    df = frame("html string", [("<p>" + "<b></b>" * 100_000 + "a sentence <i>behind</i> very many tags</p>",), ("<table><tr><td>" + "<b> </b>" * 100_000 + "x</td></tr></table>",)])
    assert df.select(payloads.page_text(F.col("html"))).first()[0] == "a sentence behind very many tags"
    wide = df.select(F.replace("html", F.lit("</table>"), F.lit("<tr><td>1</td></tr></table>")).alias("html"))
    assert payloads.page_headers(wide, "html") == ["x"]


def test_entities(frame):
    text = "a &lt;b&gt; &amp;lt; &#8217;&#x2019;&rsquo; &mdash; &#128; &#xD800; AT&T &bogus; &#0; R&D; &Aacute; x&nbsp;y &#99999999;"
    want = "a <b> &lt; ’’’ — € � AT&T &bogus; � R&D; Á x y &#99999999;"
    df = frame("t string", [(text,), (None,), ("",), ("no entity",), ("&",), ("&&amp;&",)])
    assert [r[0] for r in df.select(payloads.decode_entities(F.col("t"))).collect()] == [want, None, "", "no entity", "&", "&&&"]


def test_tables_inside_a_table(frame):
    page = ("<TABLE><tr><th>Date</th><th>Diesel</th></tr><tr><td>2024-01-01<table><tr><td>2024-02-02</td><td>9</td></tr><tr><td>x</td></tr></table></td><td>1</td></tr>"
            "<tr><td>2024-01-03<td>3<tr><td>2024-01-04</td><td>4</td></tr></table><table><tr><td>2024-05-05</td><td>7</td></tr></table>")
    df = frame("id int, html string", [(1, page)])
    rows = payloads.explode_html_table(df, "html", ["id"])
    assert [(r["row_no"], r["cells"][-1]) for r in rows.collect()] == [(1, "1"), (2, "3"), (3, "4"), (4, "9"), (5, "x")]
    assert rows.first()["cells"][0].split() == ["2024-01-01", "2024-02-02", "9", "x"]
    days = sorted((str(r["d"]), r["value"]) for r in payloads.dated_values(rows, keep=["id"]).collect())
    assert ("2024-01-03", 3.0) in days and ("2024-01-04", 4.0) in days and ("2024-02-02", 9.0) in days


def test_scraped_rows_take_the_header_of_the_page(frame):
    df = frame("day date, html string", [(day("2024-01-02"), "<table><tr><th>Item</th><th> Price </th></tr><tr><td>a</td><td>1</td></tr></table>")])
    got = payloads.scraped_rows(df, "html", "day")
    assert got.columns == ["Date", "row_no", "item", "price"] and [tuple(r) for r in got.collect()] == [("01/02/2024", 1, "a", "1")]


# --- increments --------------------------------------------------------------
OLD = [("a", day("2024-01-01"), 1.0), ("a", day("2024-01-02"), 2.0)]
NEW = [("a", day("2024-01-02"), 20.0), ("a", day("2024-01-03"), 30.0), ("b", day("2021-12-31"), 1.0), ("b", day("2022-01-01"), 2.0)]
SCHEMA = "k string, d date, x double"


def test_new_rows(frame):
    old, new = frame(SCHEMA, OLD), frame(SCHEMA, NEW)
    keyed = sorted(map(tuple, increments.new_rows(new, old, ["k"]).collect()))
    assert keyed == [("a", day("2024-01-03"), 30.0), ("b", day("2022-01-01"), 2.0)]
    assert [r["x"] for r in increments.new_rows(new, old).collect()] == [30.0]
    assert increments.new_rows(new, old.limit(0)).count() == 3
    assert increments.new_rows(new, old, until="2024-01-02").count() == 0


def test_upsert_direction(frame):
    old, new = frame(SCHEMA, OLD), frame(SCHEMA, NEW)
    first = {(r["k"], r["d"]): r["x"] for r in increments.upsert(old, new, ["k", "d"], "first").collect()}
    last = {(r["k"], r["d"]): r["x"] for r in increments.upsert(old, new, ["k", "d"], "last").collect()}
    key = ("a", day("2024-01-02"))
    assert (first[key], last[key]) == (2.0, 20.0) and set(first) == set(last) and len(first) == 5


def test_upsert_properties(frame):
    old, new = frame(SCHEMA, OLD), frame(SCHEMA, NEW)
    collect = lambda df: sorted(map(tuple, df.collect()))
    assert collect(increments.upsert(old, old, ["k", "d"])) == collect(old)
    assert collect(increments.upsert(old, new, ["k", "d"], "first")) == collect(increments.upsert(new, old, ["k", "d"], "last"))


def test_first_row_is_taken_before_sorting(frame):
    df = frame("d date, seq int, x double", [(day("2024-01-01"), 2, 9.0), (day("2024-01-01"), 1, 5.0)])
    assert increments.dedupe_by(df, ["d"], ["seq"]).first()["x"] == 5.0
    assert increments.dedupe_by(df, ["d"], ["seq"], "last").first()["x"] == 9.0


def test_append_repeats_a_repeated_delivery(frame):
    old = frame(SCHEMA, OLD)
    twice = increments.append(old, old).groupBy("d").agg(F.avg("x"), F.sum("x")).orderBy("d").collect()
    assert [tuple(r)[1:] for r in twice] == [(1.0, 2.0), (2.0, 4.0)]


def test_dedupe_compares_dates_as_dates(frame):
    df = frame("Date string, x int", [("2024-01-01", 1), ("2024-01-01 00:00:00", 1), ("2024-01-02", 1)])
    assert increments.dedupe(df).count() == 3 and increments.dedupe(df, ["Date"]).count() == 2


def test_upsert_partitions_touches_only_its_months(spark, frame):
    path = scratch_path(spark, "part")
    build = lambda rows: tables.with_month(frame(SCHEMA, rows))
    increments.upsert_partitions(path, build([*OLD, ("a", day("2024-02-01"), 5.0)]), ["k", "d"], "month")
    february = lambda: {f for f in spark.read.parquet(path).inputFiles() if "month=2024-02-01" in f}
    before = february()
    increments.upsert_partitions(path, build([("a", day("2024-01-02"), 20.0)]), ["k", "d"], "month")
    after = spark.read.parquet(path)
    assert sorted((str(r["d"]), r["x"]) for r in after.collect()) == [("2024-01-01", 1.0), ("2024-01-02", 20.0), ("2024-02-01", 5.0)]
    assert before and february() == before


# --- real pages --------------------------------------------------------------
def test_comments_and_quoted_marks_are_no_rows(frame):
    page = ('<script>"<table><tr><td>s</td></tr></table>"</script><!-- <table><tr><td>old</td></tr></table> --><table title="a > b" class=\'x>y\'>'
            '<tr><th data-x="1>0">Date</th><th>Diesel</th></tr><!-- <tr><td>2001-01-01</td><td>1</td></tr> -->'
            '<tr onclick="a<b"><td title="3 > 2">2024-01-02</td><td>5</td></tr></table>')
    df = frame("id int, html string", [(1, page), (2, None), (3, ""), (4, "<table><tr><th>date<th>diesel<tr><td>2024-01-03<td>6")])
    rows = payloads.explode_html_table(df, "html", ["id"]).collect()
    assert [(r["id"], r["header"], r["cells"]) for r in rows] == [
        (1, ["date", "diesel"], ["2024-01-02", "5"]), (4, ["date", "diesel"], ["2024-01-03", "6"])]


def test_paragraphs_without_an_end(frame):
    one, two, three = (f"A sentence number {n} that is long enough to stay." for n in ("one", "two", "three"))
    page = f'<div><p class="a>b">{one}<p>{two}</div><p>{three}<ul><li>no paragraph, however long it may be, really</li></ul><!-- <p>{one}</p> -->'
    df = frame("html string", [(page,), (f"<p>{one}",), (None,)])
    assert [r[0] for r in df.select(payloads.page_text(F.col("html"))).collect()] == [f"{one} {two} {three}", one, ""]


def test_each_page_names_its_own_columns(frame):
    table = lambda *rows: "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    pages = [table(("Item", "Price"), ("a", "1")), table(("Price", "Item", "Unit"), ("2", "b", "kg")), table(("Item", "", "Item"), ("c", "x", "d"))]
    df = frame("id int, day date, html string", [(i, day("2024-01-02"), p) for i, p in enumerate(pages)])
    got = payloads.scraped_rows(df, "html", "day", keep=["id"])
    assert got.columns == ["id", "Date", "row_no", "item", "price", "column_2", "item_2", "unit"]
    assert sorted(tuple(r)[3:] for r in got.collect()) == sorted([("a", "1", None, None, None), ("b", "2", None, None, "kg"), ("c", None, "x", "d", None)])


def test_bare_ampersands_in_feeds(frame):
    feed = lambda title: f"<rss><channel><item><title>{title}</title><link>http://x/?a=1&b=2</link></item></channel></rss>"
    df = frame("x string", [(feed("R&D &amp; more &#38; &nbsp; end"),), (feed("<![CDATA[A & B &amp; C]]>"),), ("no feed at all",), (None,)])
    rows = sorted((r["title"], r["url"]) for r in payloads.explode_rss(df, "x").collect())
    assert rows == sorted([("R&D & more & &nbsp; end", "http://x/?a=1&b=2"), ("A & B &amp; C", "http://x/?a=1&b=2")])
    assert tuple(payloads.unread_feeds(df, "x").first()) == (4, 2)


def test_common_forms_of_dates(frame):
    from tidemark.functions.dates import parse_date

    forms = ["1/5/2024 10:20 AM", "Fri, 05 Jan 2024", "2024.01.05", "5-Jan-2024", "Jan 5 2024", "01/05/24", "Friday 5 January 2024", "2024-01-05T10:20:30Z", "January 5 2024 11:00 p.m."]
    df = frame("t string", [(f,) for f in [*forms, "Fri", "13/13/2024", "", None]])
    got = [r[0] for r in df.select(parse_date(F.col("t"))).collect()]
    assert got == [day("2024-01-05")] * len(forms) + [None] * 4


def test_quotes_are_parsed_once(spark, tmp_path):
    from tidemark.plans import dataset

    raw = spark.createDataFrame([("1/2/2024", "गोलभेडा ठूलो(नेपाली)", "रू १०"), ("not a day", "गोलभेडा ठूलो", "2"), (None, "x", "-")],
                                list(fixed.QUOTE_COLUMNS))
    raw.write.parquet(f"{tmp_path}/q")
    daily = dataset.daily_price(dataset.quote_rows(spark.read.parquet(f"{tmp_path}/q")), keys=["commodity"])
    assert [(r["commodity"], r["d"], r["Average_Price"]) for r in daily.collect()] == [("Tomato_Big", day("2024-01-02"), 10.0)]
    assert daily._jdf.queryExecution().optimizedPlan().toString().count("yyyyMMdd") == 1


def test_only_formats_of_the_same_shape_are_tried(spark):
    from tidemark.functions import dates

    texts = [
        "2024-1-2", "+12024-01-02", "-2024-01-02", "2024-000001-02", "01/02/2024", "2024/1/2", "1/2/24", "1/2/2", "2024.1.2", "20240102", "202401",
        "2 Jan 2024", "2 january 2024", "2-JAN-2024", "2-May-2024", "Jan 2, 2024", "May 2, 2024", "March 2 2024", "Mar  2 2024", "2 Jan 24", "not a day",
        "Mon, 2 Jan 2024", "2024-01-02T00:00:00", "1/2/2024 3:04 PM", "2024-13-01", "2024-02-30", "", " ", "-", "2024-01-02\n", "२०२४-१-२", "2 ſep 2024", None,
    ]
    cut = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), dates._TIME_OF_DAY, ""), dates._WEEKDAY, "")
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for date_format in (*dates.DATE_FORMATS, "MM/dd/yyyy", "yyyy-MM-dd HH:mm"):
        assert dates._shape(date_format) or "H" in date_format
        got = df.select("t", dates.parse_date(F.col("t"), [date_format]).alias("got"), F.try_to_date(cut(F.col("t")), date_format).alias("want"))
        assert got.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    got = df.select("t", dates.parse_date(F.col("t")).alias("got"), F.coalesce(*[F.try_to_date(cut(F.col("t")), f) for f in dates.DATE_FORMATS]).alias("want"))
    assert got.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_cells_are_cut_once(spark, tmp_path):
    spark.createDataFrame([(1, "<table><tr><th>a</th></tr><tr><td> x &amp; <b>y</b></td></tr></table>")], "id int, html string").write.parquet(f"{tmp_path}/p")
    rows = payloads.explode_html_table(spark.read.parquet(f"{tmp_path}/p"), "html", ["id"])
    assert [tuple(r) for r in rows.collect()] == [(1, ["a"], 1, ["x &y"])]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("<[^>]*>") == 2  # of the header and of the body


def test_content_is_what_one_pattern_finds(spark):
    texts = ["<tr>a</tr>b", "<tr a>b", "<TR>a</TR>", "<tr", "<tr </tr>a>b</tr >c", "<tr>", "<tr></tr>", "<tr>a</trx>b</tr>", "<tr>a>b\nc</tr\n>", "<tr>a<tr>b</tr>", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.regexp_extract("t", r"(?is)^<(?:tr)\b[^>]*>(.*?)(?:</(?:tr)\b|\z)", 1)
    got = df.select("t", payloads._content(F.col("t"), r"</(?:tr)\b").alias("got"), want.alias("want"))
    assert got.where("t is not null and not (got <=> want)").collect() == []
