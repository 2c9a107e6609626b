"""Exact quantiles that never gather a group in one task.

Rows are first reduced to one row per group and value, with map-side combine. These are sorted by a
range partitioning, so a group of any size may reach over many partitions. Running counts within
each partition, plus the counts of the group's earlier partitions from a short table, give every
value its range of ranks; the values at the two ranks around a quantile are picked by an
aggregation. There is one plan for all group sizes, and the result is the exact linear-interpolation quantile.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialise

MOMENTS = ("n", "mean", "min", "max", "sd")


def values_of(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The key and value columns, without rows that lack a key or a number."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    present = [F.col(k).isNotNull() for k in keys] + [F.col("_v").isNotNull(), ~F.isnan("_v")]
    return rows.filter(reduce(lambda a, b: a & b, present))


def _moments() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg("_v").alias("mean"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.stddev_samp("_v").alias("sd"),
    ]


def describe_values(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], distinct_values: bool = False) -> DataFrame:
    """``keys``, n, mean, min, max, sd and the array ``q`` (and n_distinct) of the ``_v`` column."""
    keys = list(keys)
    groups = rows.groupBy(*keys).agg(*_moments())
    found = _join(groups, _quantiles(rows, keys, probs), keys)
    return found.select(*keys, *MOMENTS, "q", *(["n_distinct"] if distinct_values else []))


def _quantiles(rows: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    counts = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    order = [*keys, "_v"]
    placed = materialise(counts.repartitionByRange(*order).select(*order, "_c", F.spark_partition_id().alias("_part")))
    # At most one row per group and partition: a group has more than one only if it is larger than a partition.
    parts = placed.groupBy(*keys, "_part").agg(F.sum("_c").alias("_rows"), F.count(F.lit(1)).alias("_kinds"))
    whole = Window.partitionBy(*(keys or [F.lit(1)]))
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *keys, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"), F.sum("_rows").over(whole).alias("_n"), F.sum("_kinds").over(whole).alias("n_distinct")
    )
    upto = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum("_c").over(upto)).join(offsets, [*keys, "_part"])
    first, last = F.col("_offset") + F.col("_upto") - F.col("_c"), F.col("_offset") + F.col("_upto") - 1

    def at(rank: Column) -> Column:
        return F.max(F.when(F.floor(rank).between(first, last), F.col("_v")))

    ranks = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    picks = [pick for i, r in enumerate(ranks) for pick in (at(r).alias(f"_a{i}"), at(F.ceil(r)).alias(f"_b{i}"))]
    found = ranked.groupBy(*keys).agg(*picks, F.max("_n").alias("_n"), F.max("n_distinct").alias("n_distinct"))

    def between(i: int) -> Column:
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
        return F.when(a == b, a).otherwise((F.ceil(ranks[i]) - ranks[i]) * a + (ranks[i] - F.floor(ranks[i])) * b)

    return found.select(*keys, F.array(*[between(i) for i in range(len(probs))]).alias("q"), "n_distinct")


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join on the keys; without keys the right side is a single row and becomes scalar subqueries."""
    if keys:
        return left.join(right, keys)
    return left.withColumns({c: right.select(c).scalar() for c in right.columns})
