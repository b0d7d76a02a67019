"""Tables in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import no_nan


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "csv",
    required: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Read with an explicit schema; malformed cells become NULL.

    A missing path gives an empty table with the same schema, so later joins keep
    their columns, unless ``required``. Undecodable bytes turn into U+FFFD, and NaN
    becomes NULL.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
    try:
        table = reader.format(fmt).load(path)
        floats = [n for n, t in table.dtypes if t in ("double", "float")]
        return table.withColumns({n: no_nan(F.col(f"`{n}`")) for n in floats}) if floats else table
    except AnalysisException as err:
        if required or err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None
) -> None:
    """Replace the table at ``path``; CSV gets a header line."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def with_month(df: DataFrame, d: str = "d") -> DataFrame:
    """Partition column ``month`` (first day of the month) for long daily tables."""
    return df.withColumn("month", F.trunc(d, "month"))


def drop_if_exists(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the columns that exist, ignore the others."""
    return df.drop(*names)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def columns_containing(df: DataFrame, *parts: str, ignore_case: bool = False) -> list[str]:
    """Names that contain any of the parts (driver metadata only)."""
    fold = str.lower if ignore_case else str
    return [c for c in df.columns if any(fold(p) in fold(c) for p in parts)]
