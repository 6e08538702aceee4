"""Even thinning of ordered series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stride_sample(series: DataFrame, *, key: str = "market", order: str = "window_start", points: int = 600) -> DataFrame:
    """Every k-th row of each key, k = max(1, rows // points): fewer than 2 * points rows a key. Rows are windows, few a key."""
    own = Window.partitionBy(key)
    numbered = series.withColumns({"__r": F.row_number().over(own.orderBy(order)) - 1, "__n": F.count(F.lit(1)).over(own)})
    return numbered.where(F.col("__r") % F.greatest(F.lit(1), F.floor(F.col("__n") / points)) == 0).drop("__r", "__n")
