"""Window patterns that stay bounded when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lag_by_day(df: DataFrame, key: str, order: list[str], cols: list[str], day: Column,
               suffix: str = "_prev") -> DataFrame:
    """``lag(c)`` over (PARTITION BY key ORDER BY order) for each c in ``cols``, one task per (key, day).

    A window over the whole period puts every row of a key into one task. Here it runs per
    (key, day); only the first row of a day lacks its predecessor, which is the last row of the
    key's previous day with rows. Those last rows (one per key and day, a partially aggregated
    maximum) are few; they are shifted by one day within the key and joined back on the
    partitioning the window already has, so the rows are shuffled and windowed once.

    ``order`` + ``cols`` form the sort key: ties are broken by the values themselves. ``key`` and
    ``day`` are matched null-safely, as a window matches them.
    """
    sort = list(dict.fromkeys(order + cols))
    rows = df.withColumn("_day", day)
    last = rows.groupBy(F.col(key).alias("_k"), F.col("_day").alias("_d")).agg(
        F.max(F.struct(*sort)).alias("_last"))
    carry = last.select("_k", "_d", F.lag("_last").over(Window.partitionBy("_k").orderBy("_d")).alias("_carry"))
    w = Window.partitionBy(key, "_day").orderBy(*sort)
    inside = rows.select("*", F.row_number().over(w).alias("_rn"),
                         *[F.lag(c).over(w).alias(f"{c}{suffix}") for c in cols])
    joined = inside.join(carry, F.col(key).eqNullSafe(F.col("_k")) & F.col("_day").eqNullSafe(F.col("_d")), "left")
    previous = [F.when(F.col("_rn") == 1, F.col("_carry")[c]).otherwise(F.col(f"{c}{suffix}")).alias(f"{c}{suffix}")
                for c in cols]
    return joined.select(*df.columns, *previous)
