"""Small printed tables of the study."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_predictions(pred: DataFrame, k: int = 10, keys: Sequence[str] = ("series_id",), d: str = "d") -> DataFrame:
    """The first ``k`` test dates of each series, actual against predicted price."""
    test = pred.where((F.col("split") == "test") & F.col("y_pred").isNotNull())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(d))
    rows = test.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return rows.select(*keys, d, F.exp("y_true").alias("actual"), F.exp("y_pred").alias("predicted"))
