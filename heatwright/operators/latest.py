"""Newest row, newest rows and newest value per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in the given order.

    Spark cuts each key before the shuffle (WindowGroupLimit, for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, which ``prepare`` raises), so a hot key arrives
    as at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_n_per_key(df, keys, order, 1)


def newest_place(column: str, order: Sequence[str]) -> Column:
    """Aggregate: a column's newest value that is not null, behind its place, as ``{k0, ..., v}``.

    The greatest of several such places is that of all their rows, so totals of parts can be totalled again.
    """
    value = F.col(column)
    position = F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(order)], value.alias("v"))
    return F.max(F.when(value.isNotNull(), position))


def latest_non_null(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Per key and for each column on its own: the newest value that is not null.

    Newest is the greatest ``order``, then the greatest value. Rows with a null key are left out. It
    is a plain aggregate, so a hot key is reduced before the shuffle.
    """

    def newest(column: str) -> Column:
        value = F.col(column)
        position = F.struct(*[F.col(name).alias(f"k{i}") for i, name in enumerate(order)], value.alias("v"))
        # max_by passes over rows whose ordering is null.
        return F.max_by(value, F.when(value.isNotNull(), position)).alias(column)

    known = df.where(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))
    return known.groupBy(*keys).agg(*[newest(column) for column in columns])
