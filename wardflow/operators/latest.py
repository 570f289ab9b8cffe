"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, newest_first: Sequence[Column]) -> DataFrame:
    """Keep one row per ``key``: the first in ``newest_first`` order.

    The rank filter lets Spark cut every task's rows to one per key before the
    shuffle (WindowGroupLimit), so a key with very many records sends at most
    one row per input task.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
