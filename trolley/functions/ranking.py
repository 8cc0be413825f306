"""Ranking and top-k helpers.

Every ordering ends in a unique key so results are deterministic (pandas
``nlargest`` keeps first-seen; SQL ``LIMIT`` is arbitrary on ties).
``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: each task keeps
its own n best rows, so only n x tasks rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def two_sided(df: DataFrame, n: int, metric: str, tie: str, low_label: str, high_label: str,
              group_col: str = "group") -> DataFrame:
    """n lowest and n highest rows by ``metric`` (ties by ``tie``), tagged, as one frame (bag union)."""
    m = F.col(metric)
    low = top_k(df, n, m.asc_nulls_last(), F.col(tie).asc()).withColumn(group_col, F.lit(low_label))
    high = top_k(df, n, m.desc_nulls_last(), F.col(tie).asc()).withColumn(group_col, F.lit(high_label))
    return low.unionByName(high)


def top_n_per_group(df: DataFrame, group: str, n: int, *order: Column, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n within each group (``row_number`` over a partitioned window)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)
