"""Columnar JSON, feeds, HTML tables and page text: one row-local projection each."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.dates import extract_ad_date, parse_rfc822
from tidemark.functions.numbers import to_float
from tidemark.functions.rows import row_mean

_BLANKS = " \t\n\r\f\u000b"
_ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
RSS_SCHEMA = (
    "channel struct<item:array<struct<title:string,link:string,pubDate:string,"
    "source:struct<_VALUE:string,_url:string>>>>"
)
WEATHER_FIELDS = {
    "time": "string",
    "temperature_2m_max": "double",
    "temperature_2m_min": "double",
    "surface_pressure_max": "double",
    "surface_pressure_min": "double",
    "wind_speed_10m_max": "double",
    "precipitation_sum": "double",
}


def explode_columnar_json(
    df: DataFrame, col: str, fields: Mapping[str, str], root: str = "daily", keep: Sequence[str] = ()
) -> DataFrame:
    """``{root: {a: [...], b: [...]}}`` to one row per position; no ``root``, no rows."""
    inner = ",".join(f"`{n}`:array<{t}>" for n, t in fields.items())
    parsed = df.select(*keep, F.from_json(F.col(col), f"{root} struct<{inner}>").alias("_p"))
    zipped = F.arrays_zip(*[F.col(f"_p.{root}.{n}").alias(n) for n in fields])
    return parsed.select(*keep, F.inline(zipped).alias(*fields))


def weather_rows(df: DataFrame, col: str, location: str = "location") -> DataFrame:
    """Daily weather payloads to the long table ``(location, d, metrics…)``."""
    rows = explode_columnar_json(df, col, WEATHER_FIELDS, keep=[location])
    c = F.col
    return rows.select(
        location,
        F.try_to_date(c("time"), "yyyy-MM-dd").alias("d"),
        row_mean([c("temperature_2m_max"), c("temperature_2m_min")]).alias("Temperature"),
        row_mean([c("surface_pressure_max"), c("surface_pressure_min")]).alias("Air_Pressure"),
        c("wind_speed_10m_max").alias("Wind_Speed"),
        c("precipitation_sum").alias("Precipitation"),
        c("precipitation_sum").alias("Rainfall_MM"),
    )


#: An ``&`` that begins no entity of XML.
_BARE = r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#[xX][0-9A-Fa-f]+);)"


def _whole_entities(xml: Column) -> Column:
    """``&`` that begins no entity of XML, as ``&amp;``; text in CDATA is left alone."""
    pieces = F.split(xml, r"(?=<!\[CDATA\[)|(?<=\]\]>)")
    spelt = F.transform(pieces, lambda x: F.when(x.startswith("<![CDATA["), x).otherwise(F.regexp_replace(x, _BARE, "&amp;")))
    return F.when(xml.rlike(_BARE), F.array_join(spelt, "")).otherwise(xml)


def unread_feeds(df: DataFrame, col: str) -> DataFrame:
    """``(feeds, unread)``: how many texts there are, and in how many no channel was found."""
    channel = F.from_xml(_whole_entities(F.col(col)), RSS_SCHEMA).getField("channel")
    return df.select(channel.isNull().alias("_none")).agg(F.count(F.lit(1)).alias("feeds"), F.count_if("_none").alias("unread"))


def explode_rss(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Feed XML to one row per item; absent children are empty strings.

    A bare ``&``, which feeds often have, is read as one. A feed that is no XML gives no row; ``unread_feeds`` counts these.
    """
    item = F.explode(F.from_xml(_whole_entities(F.col(col)), RSS_SCHEMA).getField("channel").getField("item"))
    rows = df.select(*keep, item.alias("_i"))

    def text(path: str) -> Column:
        return F.coalesce(F.btrim(F.col(path), F.lit(_BLANKS)), F.lit(""))

    return rows.select(
        *keep,
        text("_i.title").alias("title"),
        text("_i.link").alias("url"),
        text("_i.pubDate").alias("pub_date_raw"),
        text("_i.source._VALUE").alias("source"),
        parse_rfc822(F.col("_i.pubDate")).alias("published_at"),
    )


def _named_entities() -> dict[str, str]:
    """All names of HTML with a semicolon, from the standard library; a non-breaking blank is a blank."""
    return {name[:-1]: text.replace("\u00a0", " ") for name, text in html5.items() if name.endswith(";")}


def _code_point(number: Column) -> Column:
    """The character of a numeric entity, read as browsers do: 128 to 159 as Windows-1252, what is no character as U+FFFD."""
    western = bytes(range(128, 160)).decode("cp1252", errors="replace")
    low = F.substring(F.lit(western), number - 127, F.lit(1))
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number < 0x110000))
    known = F.when(valid, number).otherwise(0xFFFD)
    char = F.decode(F.unhex(F.lpad(F.hex(known), 8, "0")), "UTF-32")
    return F.when(number.between(128, 159), low).when(number == 160, F.lit(" ")).otherwise(char)


def decode_entities(text: Column) -> Column:
    """Each entity once: names of HTML, decimal and hexadecimal numbers. Anything else stays as it is."""
    table = F.from_json(F.lit(json.dumps(_named_entities())), "map<string,string>")

    def decoded(piece: Column) -> Column:
        name = F.regexp_extract(piece, _ENTITY, 1)
        hexadecimal = F.conv(F.substring(name, F.lit(3), F.length(name)), 16, 10).cast("int")
        number = F.when(F.lower(name).startswith("#x"), hexadecimal).when(
            name.startswith("#"), F.substring(name, F.lit(2), F.length(name)).cast("int")
        )
        char = F.when(number.isNotNull(), _code_point(number)).otherwise(F.try_element_at(table, name))
        return F.coalesce(F.concat(char, F.substring(piece, F.length(name) + 2, F.length(piece))), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decoded)
    return F.when(text.contains("&"), F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))).otherwise(text)


def _text_nodes(fragment: Column, glue: str) -> Column:
    """Text nodes of a fragment, trimmed and joined; entities are left as they are."""
    nodes = F.transform(F.split(fragment, r"<[^>]*>"), lambda x: F.btrim(x, F.lit(_BLANKS)))
    return F.when(fragment.contains("<"), F.array_join(F.filter(nodes, lambda x: x != ""), glue)).otherwise(F.btrim(fragment, F.lit(_BLANKS)))


#: What is no markup to be read: comments, and the bodies of scripts and styles.
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
#: A whole tag; quoted attributes may hold any character.
_TAG = r"""(?s)<(/?[A-Za-z][A-Za-z0-9]*)(?:[\s/](?:"[^"]*+"|'[^']*+'|[^"'<>]++)*+)?>"""


def plain_markup(page: Column) -> Column:
    """A page without comments, scripts, styles and attributes, so that ``<`` and ``>`` are only those of tags."""
    return F.regexp_replace(F.regexp_replace(page, _UNREAD, " "), _TAG, "<$1>")


def _strip_tags(fragment: Column, glue: str = "") -> Column:
    """Text of a fragment: its text nodes trimmed and joined, entities decoded.

    Tags are cut one at a time, so that a fragment may hold any number of them.
    """
    return decode_entities(_text_nodes(fragment, glue))


def _content(element: Column, end: str) -> Column:
    """What stands behind an element's first ``>`` and before its first ``end``; empty if its tag does not end.

    Two cuts at marks: one pattern for both would try its end at each character.
    """
    inner = F.coalesce(F.get(F.split(element, ">", 2), F.lit(1)), F.lit(""))
    return F.get(F.split(inner, rf"(?i){end}", 2), F.lit(0))


def _elements(text: Column, tags: str) -> Column:
    """Inner text of each ``tags`` element; an end tag may be missing, as HTML allows."""
    pieces = F.filter(F.split(text, rf"(?i)(?=<(?:{tags})\b)"), lambda x: x.rlike(rf"(?i)^<(?:{tags})\b"))
    return F.transform(pieces, lambda x: _content(x, rf"</(?:{tags})\b"))


def _cells(row: Column, tags: str) -> Column:
    """Cell texts; ``td`` and ``th`` both end the cell before them."""
    pieces = F.filter(F.split(row, r"(?i)(?=<t[dh]\b)"), lambda x: x.rlike(rf"(?i)^<(?:{tags})\b"))
    inner = F.transform(pieces, lambda x: _content(x, r"</t[dh]\b"))
    # Two steps: the second reads the text at several places, and in a lambda each of them would cut the tags again.
    return F.transform(F.transform(inner, lambda x: _text_nodes(x, "")), decode_entities)


def _first_table(page: Column) -> Column:
    """The first table's content in pieces ``(depth, text)``: depth 1 is its own, more that of tables inside it."""
    parts = "array<struct<depth:int,text:string>>"
    state = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast(parts).alias("parts"))

    def follow(s: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)^<table\b"), piece.rlike(r"(?i)^</table")
        depth = (s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)).cast("int")
        text = F.regexp_replace(piece, r"(?is)^</?table\b[^>]*>", "")
        new = F.struct(depth.alias("depth"), text.alias("text"))
        inside = (opens | closes) & (depth > 0)
        moved = F.struct(
            depth.alias("depth"), (closes & (depth == 0)).alias("done"),
            F.when(inside, F.concat(s["parts"], F.array(new))).otherwise(s["parts"]).cast(parts).alias("parts"),
        )
        return F.when(s["done"] | (closes & (s["depth"] == 0)), s).otherwise(moved)

    return F.aggregate(F.split(page, r"(?i)(?=</?table\b)"), state, follow, lambda s: s["parts"])


def explode_html_table(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """First table of each page: ``(keep…, header, row_no, cells)``, header in lower case.

    Header cells may be ``th`` or ``td``; body rows are read from ``td`` and rows
    without any are left out. Comments and scripts are no rows. Rows of tables inside the first one follow its own rows;
    in its own rows such a table is text of the cell that holds it.
    """
    page = F.col("_page")
    found = df.select(*keep, plain_markup(F.col(col)).alias("_page"))
    # Most pages have one table, or none inside another: there the rows are those up to its end.
    tags = F.lower(F.array_join(F.regexp_extract_all(page, F.lit(r"(?i)</?table"), F.lit(0)), ""))
    nested = tags.contains("<table<table")
    simple = _elements(F.get(F.split(F.get(F.split(page, "(?i)<table>", 2), F.lit(1)), "(?i)</table", 2), F.lit(0)), "tr")
    lines = F.when(nested, _nested_lines(_first_table(page))).otherwise(simple)
    header = F.transform(_cells(F.get(F.col("_lines"), F.lit(0)), "th|td"), F.lower)
    body = F.transform(
        "_lines", lambda line, i: F.struct(i.alias("row_no"), F.when(i > 0, _cells(line, "td")).alias("cells"))
    )
    # Rows are sifted inside the array: a filter after the explode would be pushed below
    # the projection and parse everything once more.
    body = F.filter(body, lambda r: F.size(r["cells"]) > 0)
    # The header gets a projection of its own: next to a generator it would be
    # evaluated once per generated row.
    found = found.select(*keep, lines.alias("_lines"))
    return found.select(*keep, "_lines", header.alias("header")).select(*keep, "header", F.inline(body).alias("row_no", "cells"))


def _nested_lines(parts: Column) -> Column:
    """Rows of a table in pieces ``(depth, text)``: its own, then those of the tables inside it."""
    flat = F.transform(
        parts,
        lambda p: F.when(p["depth"] == 1, p["text"]).otherwise(F.regexp_replace(p["text"], r"(?is)</?(?:tr|t[dh]|thead|tbody|tfoot)>", " ")),
    )
    inner = F.flatten(F.transform(F.filter(parts, lambda p: p["depth"] > 1), lambda p: _elements(p["text"], "tr")))
    return F.concat(_elements(F.array_join(flat, ""), "tr"), inner)


def _named(header: Column) -> Column:
    """Names for the columns of a page: a name that comes again gets a number, an empty one its place."""

    def name(h: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(header, F.lit(1), i), lambda x: x == h))
        return F.when(h == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).when(
            before > 0, F.concat(h, F.lit("_"), (before + 1).cast("string"))
        ).otherwise(h)

    return F.transform(header, name)


def page_headers(df: DataFrame, col: str) -> list[str]:
    """Header cells of the first tables of all pages, in lower case: by their first place, then by name; a row for each comes to the driver."""
    pages = explode_html_table(df, col).select(F.posexplode(_named(F.col("header"))).alias("place", "name"))
    rows = pages.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name").collect()
    return [r["name"] for r in rows]


def _positions(header: Column, words: Sequence[str]) -> Column:
    """Zero-based positions of the headers that contain any of the words."""
    marked = F.transform(
        header, lambda h, i: F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: h.contains(w)), i)
    )
    return F.filter(marked, lambda i: i.isNotNull())


def dated_values(
    rows: DataFrame,
    date_words: Sequence[str] = fixed.PAGE_DATE_WORDS,
    value_words: Sequence[str] = fixed.PAGE_VALUE_WORDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of :func:`explode_html_table` to ``(keep…, row_no, d, value)``.

    The date stands under the **first** date-like header, the value under the
    **last** value-like one. Rows too short or not parseable are left out.
    """
    dates, values = _positions(F.col("header"), date_words), _positions(F.col("header"), value_words)
    raw_date = F.get("cells", F.get(dates, F.lit(0)))
    raw_value = F.replace(F.get("cells", F.try_element_at(values, F.lit(-1))), F.lit(","), F.lit(""))
    found = F.struct(extract_ad_date(raw_date).alias("d"), to_float(raw_value).alias("value"))
    whole = F.filter(F.array(found), lambda r: r["d"].isNotNull() & r["value"].isNotNull())
    return rows.select(*keep, "row_no", F.inline(whole).alias("d", "value"))


def scraped_rows(
    df: DataFrame, col: str, scrape_date: str, names: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Market listing pages to a table: the scrape date first, then the cells.

    With ``names`` cells stand by position. Without them the columns are the headers of all pages, and each
    page's cells stand under its own headers, in whatever order it has them.
    """
    rows = explode_html_table(df, col, [*keep, scrape_date])
    if names is not None:
        cells = [F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)]
    else:
        rows = rows.withColumn("header", _named(F.col("header")))
        place = lambda n: F.array_position("header", n).cast("int")
        cells = [F.when(place(n) > 0, F.get("cells", place(n) - 1)).alias(n) for n in page_headers(df, col)]
    return rows.select(*keep, F.date_format(scrape_date, "MM/dd/yyyy").alias("Date"), "row_no", *cells)


#: Tags that end a paragraph whose own end is missing: blocks that begin, and the ends of what may hold one.
_ENDS_P = (
    r"<(?:address|article|aside|blockquote|details|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|main|menu|nav|ol|p|pre|section|table|ul)>"
    r"|</(?:article|aside|blockquote|body|dd|div|fieldset|figure|footer|form|header|html|li|main|nav|section|table|td|th)>"
)


def page_text(html: Column, min_len: int = 30, max_len: int | None = None) -> Column:
    """Paragraph text of a page: paragraphs longer than ``min_len``, blanks collapsed.

    The whole page is read and its whole text returned; a caller may ask for a cut at ``max_len``.
    Scripts, styles and comments do not count as text. A paragraph ends at the next end tag of one; where none
    follows, at the next block that begins or the end of the element around it.
    """
    found = F.regexp_extract_all(plain_markup(html), F.lit(rf"(?is)<p>(?:.*?</p>|.*?(?={_ENDS_P}|\z))"), F.lit(0))
    texts = F.filter(F.transform(found, lambda p: _strip_tags(p, " ")), lambda t: F.length(t) > min_len)
    joined = F.btrim(F.regexp_replace(F.array_join(texts, " "), r"\s+", " "), F.lit(" "))
    joined = F.coalesce(joined, F.lit(""))
    return joined if max_len is None else F.substring(joined, 1, max_len)
