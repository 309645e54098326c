"""One row per key, whatever the number of deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_delivery(df: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """``key`` and ``columns`` of the earliest row by ``order``; ties take the least values.

    Rows are combined before the shuffle, so a key that holds a third of the
    rows reaches its reducer once per input task.  A null ``order`` comes last,
    and rows with a null key are one group.
    """
    late = F.col(order).isNull().alias("_late")
    best = F.min(F.struct(late, F.col(order).alias("_at"), *(F.col(c) for c in columns))).alias("_best")
    return df.groupBy(key).agg(best).select(key, *(F.col("_best")[c].alias(c) for c in columns))


def distinct_deliveries(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that differ in ``columns``; a hash aggregate, combined before the shuffle."""
    return df.select(*columns).distinct()
