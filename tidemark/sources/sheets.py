"""Sheets whose header has to be found: column discovery, header seek, sections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.dates import fiscal_start_year, month_pair_number
from tidemark.functions.numbers import to_float


def normalize_headers(df: DataFrame) -> DataFrame:
    """Headers to trimmed lower case with underscores."""
    return df.toDF(*[str(c).strip().lower().replace(" ", "_") for c in df.columns])


def discover_column(
    columns: Sequence[str],
    exact: Sequence[str] = (),
    contains_all: Sequence[Sequence[str]] = (),
    after: str | None = None,
) -> str:
    """Pick one column name.

    ``after`` wins (the column to the right of the first name containing it), then
    the first exact candidate present, then for each word group the first name that
    contains every word. No match raises.
    """
    lowered = [str(c).lower() for c in columns]
    if after is not None:
        for i, name in enumerate(lowered[:-1]):
            if after in name:
                return columns[i + 1]
    for candidate in exact:
        if candidate in columns:
            return candidate
    for words in contains_all:
        for name, low in zip(columns, lowered):
            if all(w in low for w in words):
                return name
    raise ValueError(f"no matching column among {list(columns)}")


def any_word_column(columns: Sequence[str], words: Sequence[str], after: str | None = None) -> str:
    """First column (in table order) whose name contains any of the words."""
    lowered = [str(c).lower() for c in columns]
    if after is not None:
        for i, name in enumerate(lowered[:-1]):
            if after in name:
                return columns[i + 1]
    for name, low in zip(columns, lowered):
        if any(w in low for w in words):
            return name
    raise ValueError(f"no matching column among {list(columns)}")


def rate_rows(df: DataFrame, variant: str = "cloud") -> DataFrame:
    """Two-column rate table ``(date, usd_sell)`` out of an export with varying headers."""
    table = normalize_headers(df)
    names = table.columns
    date_col = discover_column(names, fixed.DATE_HEADERS, [("date",)])
    if variant == "local":
        sell_col = discover_column(names, fixed.SELL_HEADERS_LOCAL, [("usd", "sell"), ("sell",), ("usd",)])
    else:
        sell_col = discover_column(names, fixed.SELL_HEADERS, [("usd", "sell"), ("sell",)])
    return table.select(F.col(f"`{date_col}`").alias("date"), F.col(f"`{sell_col}`").alias("usd_sell"))


def _marked(markers: Sequence[str], cells: str) -> Column:
    found = F.array(*[F.lit(m) for m in markers])
    return F.exists(cells, lambda x: F.exists(found, lambda m: F.lower(x).contains(m)))


def seek_header(
    df: DataFrame,
    markers: Sequence[str] = fixed.SHEET_MARKERS,
    sheet: str = "sheet_id",
    row_no: str = "row_no",
    cells: str = "cells",
) -> DataFrame:
    """Rows below the header of each sheet, with the header beside them.

    The header is the first row of the sheet in which some cell contains a marker, however far
    down it stands. A sheet without one gives no rows; ``sheets_without_header`` lists those.
    The header rows are found with one map-side-combined aggregate per sheet, so a very long
    sheet is not gathered anywhere. There are as many headers as sheets, and Spark takes exploded rows for
    far smaller than they are: the hint keeps either side from being sent to the driver and broadcast.
    """
    hit = F.when(_marked(markers, cells), F.col(row_no))
    header = df.groupBy(sheet).agg(F.min(hit).alias("_header_row"), F.min_by(cells, hit).alias("header"))
    return df.join(header.hint("merge"), sheet).where(F.col(row_no) > F.col("_header_row")).drop("_header_row")


def sheets_without_header(
    df: DataFrame, markers: Sequence[str] = fixed.SHEET_MARKERS, sheet: str = "sheet_id", cells: str = "cells"
) -> DataFrame:
    """Sheets in which no cell of any row contains a marker, with their number of rows."""
    found = F.max(F.coalesce(_marked(markers, cells), F.lit(False)))
    return df.groupBy(sheet).agg(F.count(F.lit(1)).alias("n_rows"), found.alias("_found")).where(~F.col("_found")).drop("_found")


def inflation_rows(
    df: DataFrame, sheet: str = "sheet_id", row_no: str = "row_no", cells: str = "cells", months: Mapping[str, int] = fixed.MONTH_PAIRS
) -> DataFrame:
    """Sheets of unknown layout to the monthly table ``(sheet, d, value)``: header, columns, fiscal years and months.

    The label stands under the first header with a date word. The value stands right of
    "overall index", else under the first header with a value word.
    """
    rows = seek_header(df, sheet=sheet, row_no=row_no, cells=cells)
    label = cell_under(fixed.SHEET_DATE_WORDS, cells=cells)
    value = F.coalesce(cell_under(["overall index"], 1, cells=cells), cell_under(fixed.SHEET_VALUE_WORDS, cells=cells))
    named = rows.select(sheet, row_no, label.alias("raw_date"), value.alias("raw_value"))
    return fiscal_months(named, file=sheet, row_no=row_no, months=months)


def cell_under(header_words: Sequence[str], offset: int = 0, header: str = "header", cells: str = "cells"):
    """The cell below the first header containing any word, ``offset`` places to the right."""
    words = F.array(*[F.lit(w) for w in header_words])
    matches = F.transform(header, lambda h: F.exists(words, lambda w: F.lower(h).contains(w)))
    at = F.array_position(matches, F.lit(True))
    return F.when(at > 0, F.get(F.col(cells), (at - 1 + offset).cast("int")))


def section_carry(
    df: DataFrame, label: str, file: str = "sheet_id", row_no: str = "row_no", block: int = 4096
) -> DataFrame:
    """Carry the last non-null ``label`` down the rows of each file.

    Two steps instead of one window over the file: inside blocks of ``block`` rows,
    then over one row per block. A file of any length is spread over many tasks.
    """
    blk = F.floor(F.col(row_no) / block)
    inside = Window.partitionBy(file, "_blk").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    tagged = df.withColumn("_blk", blk)
    last_label = F.max_by(label, F.when(F.col(label).isNotNull(), F.col(row_no)))
    over_blocks = Window.partitionBy(file).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        tagged.groupBy(file, "_blk")
        .agg(last_label.alias("_last"))
        .select(file, "_blk", F.last("_last", ignorenulls=True).over(over_blocks).alias("_before"))
    )
    carried = tagged.withColumn("_in", F.last(label, ignorenulls=True).over(inside))
    return (
        carried.join(before, [file, "_blk"])
        .withColumn(label, F.coalesce("_in", "_before"))
        .drop("_blk", "_in", "_before")
    )


def fiscal_months(
    df: DataFrame,
    raw_date: str = "raw_date",
    raw_value: str = "raw_value",
    file: str = "sheet_id",
    row_no: str = "row_no",
    months: Mapping[str, int] = fixed.MONTH_PAIRS,
) -> DataFrame:
    """Fiscal-year rows with month rows below them -> ``(file, d, value)``.

    Months from July on belong to the year the fiscal year starts in, the others to
    the next. Rows before any fiscal year, unknown labels and non-numbers are left
    out; of two rows for one month the upper one stays.
    """
    rows = df.select(
        file,
        row_no,
        fiscal_start_year(F.col(raw_date)).alias("_fy"),
        month_pair_number(F.col(raw_date), months).alias("_month"),
        to_float(F.col(raw_value)).alias("_value"),
    )
    carried = section_carry(rows.withColumn("_is_fy", F.col("_fy").isNotNull()), "_fy", file, row_no)
    year = F.when(F.col("_month") >= 7, F.col("_fy")).otherwise(F.col("_fy") + 1)
    return (
        carried.where(~F.col("_is_fy") & F.col("_month").isNotNull())
        .where(F.col("_fy").isNotNull() & F.col("_value").isNotNull())
        .select(file, row_no, F.make_date(year, F.col("_month"), F.lit(1)).alias("d"), "_value")
        .groupBy(file, "d")
        .agg(F.min_by("_value", row_no).alias("value"))
    )
