"""Order-dependent reports that never sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import cut_lineage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key in the given order.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a key
    that holds a third of all rows costs no more than any other.
    """
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def newest_rows(df: DataFrame, order: Sequence[str], limit: int, where: Column | None = None) -> DataFrame:
    """The newest rows, at most ``limit``; each task keeps its own ``limit`` best."""
    rows = df if where is None else df.where(where)
    return rows.orderBy(*[F.desc(c) for c in order]).limit(limit)


def running_total(df: DataFrame, value: str, order: Sequence[str], result: str, slices: int | None = None) -> DataFrame:
    """Cumulative sum over the whole dataset in a total order.

    A window without partitions would pull all rows into one task. So the data is cut into
    consecutive ranges of the order, as many as shuffles have partitions unless ``slices`` says
    otherwise, each range is summed up on its own, and what the ranges before it add up to is put on
    top; there is one sum for each range. ``order`` must identify a row, so that rows of one moment
    can be told apart and spread as well.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written out, so that range and rows stay as they are however often they are read.
    ranged = cut_lineage(df.repartitionByRange(slices, *order).withColumn("__slice", F.spark_partition_id()))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("__slice")
        .agg(F.sum(value).alias("s"))
        .select("__slice", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("__before"))
    )
    within = Window.partitionBy("__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.join(before, "__slice")
        .withColumn(result, F.coalesce(F.sum(value).over(within), F.lit(0)) + F.col("__before"))
        .drop("__slice", "__before")
    )
