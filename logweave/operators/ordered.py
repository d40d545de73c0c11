"""Scans along a log's order that don't put the log into one partition.

A window over a whole source would run in one task. Here the order splits into buckets of positions: each bucket is
scanned on its own, and what earlier buckets hand on comes from one row for each bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a bucket, and buckets in a group.
WIDTH, GROUP = 1 << 16, 1 << 12


def _bucketed(df: DataFrame, pos: str, width: int) -> DataFrame:
    return df.withColumn("_bucket", F.floor(F.col(pos) / width))


def _handed_on(df: DataFrame, keys: list[str], summary: Column, carried, joined) -> DataFrame:
    """df with _before: `carried` over the summaries of the earlier buckets of its keys.

    In two levels, as positions may be byte offsets and buckets many: over the buckets of a group of GROUP, and over
    the groups; `joined` puts together what the earlier groups and the group's own earlier buckets hand on.
    """
    group = Window.partitionBy(*keys, "_group").orderBy("_bucket")
    rows = df.groupBy(*keys, "_bucket").agg(summary.alias("_summary")).withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    rows = rows.withColumn("_own", carried(F.col("_summary")).over(group.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_with", carried(F.col("_summary")).over(group.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy(*keys, "_group").agg(F.max_by("_with", "_bucket").alias("_total")).withColumn("_earlier", carried(F.col("_total")).over(before)).drop("_total")
    both = rows.join(groups, [*keys, "_group"]).withColumn("_before", joined(F.col("_own"), F.col("_earlier"))).select(*keys, "_bucket", "_before")
    return df.join(both, [*keys, "_bucket"])


def carry_last(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: the last value that isn't null at this row or before it, within keys. order[0] is the position."""
    cut = _bucketed(df, order[0], width).withColumn("_value", value)
    place = F.struct(*order)
    cut = _handed_on(cut, keys, F.max_by("_value", F.when(F.col("_value").isNotNull(), place)), lambda s: F.last(s, ignorenulls=True), F.coalesce)
    own = F.last("_value", ignorenulls=True).over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn(name, F.coalesce(own, F.col("_before"))).drop("_bucket", "_value", "_before")


def previous(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: struct<v> of the row before within keys, v being null where its value was; null at the first row."""
    cut = _bucketed(df, order[0], width).withColumn("_value", F.struct(value.alias("v")))
    cut = _handed_on(cut, keys, F.max_by("_value", F.struct(*order)), lambda s: F.last(s), F.coalesce)
    own = F.lag("_value").over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return cut.withColumn(name, F.coalesce(own, F.col("_before"))).drop("_bucket", "_value", "_before")


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: the sum of value at this row and before it, within keys."""
    cut = _bucketed(df, order[0], width).withColumn("_value", value)
    cut = _handed_on(cut, keys, F.sum("_value"), F.sum, lambda own, earlier: F.coalesce(own, F.lit(0)) + F.coalesce(earlier, F.lit(0)))
    own = F.sum("_value").over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn(name, own + F.coalesce("_before", F.lit(0))).drop("_bucket", "_value", "_before")


def highest_before(df: DataFrame, keys: list[str], order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """df with `name`: the largest value of the rows before it within keys; null at the first row."""
    cut = _bucketed(df, order[0], width).withColumn("_value", value)
    cut = _handed_on(cut, keys, F.max("_value"), F.max, F.greatest)
    own = F.max("_value").over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return cut.withColumn(name, F.greatest(own, F.col("_before"))).drop("_bucket", "_value", "_before")
