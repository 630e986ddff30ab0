"""Joins of integer intervals by equality of keys instead of range comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64


def _keys(level: int, lo: Column, hi: Column) -> Column:
    pages = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(pages, lambda x: F.struct(F.lit(level).alias("level"), x.cast("long").alias("at")))


def interval_keys(lo: Column, hi: Column) -> Column:
    """Keys of an interval lo..hi (lo <= hi): its single pages outside whole blocks, and its whole blocks.

    An interval of n pages has at most 2 * BLOCK + n / BLOCK keys.
    """
    lo, hi = lo.cast("long"), hi.cast("long")
    first = F.ceil(lo / BLOCK).cast("long")
    last = F.floor((hi + 1) / BLOCK).cast("long") - 1
    blocks = first <= last
    return F.when(
        blocks, F.concat(_keys(0, lo, first * BLOCK - 1), _keys(1, first, last), _keys(0, (last + 1) * BLOCK, hi))
    ).otherwise(_keys(0, lo, hi))


def point_keys(page: Column) -> Column:
    """The two keys of a page; it shares exactly one with every interval that covers it and none with others."""
    page = page.cast("long")
    return F.array(
        F.struct(F.lit(0).alias("level"), page.alias("at")),
        F.struct(F.lit(1).alias("level"), F.floor(page / BLOCK).cast("long").alias("at")),
    )


def points_in_intervals(points: DataFrame, intervals: DataFrame, on: list[str], page: str, lo: str, hi: str) -> DataFrame:
    """Inner join of points and the intervals that cover them, by equal `on` columns and keys; no range join."""
    spread = intervals.where(F.col(lo) <= F.col(hi)).withColumn("_key", F.explode(interval_keys(F.col(lo), F.col(hi))))
    return points.withColumn("_key", F.explode(point_keys(F.col(page)))).join(spread, [*on, "_key"]).drop("_key")


def coalesce_intervals(df: DataFrame, by: list[str], lo: str, hi: str, touch: int = 1) -> DataFrame:
    """Overlapping or touching intervals of a group merged: by, lo, hi, n. Rows with a null bound are left out."""
    known = df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull())
    w = Window.partitionBy(*by).orderBy(lo, hi)
    reach = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col(lo) <= reach + touch, 0).otherwise(1)
    islands = known.withColumn("_new", new).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*by, "_island").agg(
        F.min(lo).alias(lo), F.max(hi).alias(hi), F.count(F.lit(1)).alias("n")
    ).drop("_island")
