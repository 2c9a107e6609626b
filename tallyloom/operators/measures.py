"""Cleaning and harmonising of measured values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import recode
from ..runtime import materialise
from .stats import describe_by

QC_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


def clean_measure(
    df: DataFrame, value: str, unit_id: str, unit: str, unusable: Sequence[str], synonyms: Mapping[str, str]
) -> DataFrame:
    """Drop rows without a value, a unit id or a usable unit, and merge unit spellings."""
    usable = F.col(unit).isNull() | ~F.col(unit).isin(list(unusable))
    kept = df.filter(F.col(value).isNotNull() & F.col(unit_id).isNotNull() & usable)
    return kept.withColumn(unit, recode(F.col(unit), synonyms))


def extreme_limits(df: DataFrame, keys: Sequence[str], value: str, max_pct: float = 400, min_pct: float = 400) -> DataFrame:
    """Per group the value to drop at either end, if it stands far enough off its neighbour.

    Two partial aggregations: the ends, then the nearest values inside them.
    """
    keys = list(keys)
    ends = materialise(df.groupBy(*keys).agg(F.max(value).alias("_max"), F.min(value).alias("_min")))
    v = F.col(value)
    inner = (
        df.select(*keys, value)
        .join(ends, keys)
        .groupBy(*keys)
        .agg(
            F.first("_max").alias("_max"),
            F.first("_min").alias("_min"),
            F.max(F.when(v < F.col("_max"), v)).alias("_max2"),
            F.min(F.when(v > F.col("_min"), v)).alias("_min2"),
        )
    )
    high = F.rint(F.try_divide(F.col("_max") * 100, F.col("_max2")))
    low = F.abs(F.rint(F.try_divide(F.col("_min") * 100, F.col("_min2"))))
    return inner.select(
        *keys,
        F.when(high >= max_pct, F.col("_max")).alias("drop_at_or_above"),
        F.when(low >= min_pct, F.col("_min")).alias("drop_at_or_below"),
    )


def drop_extremes(df: DataFrame, keys: Sequence[str], value: str, max_pct: float = 400, min_pct: float = 400) -> DataFrame:
    """Drop the largest value of a group if it is 400% of the next one, and likewise the smallest.

    Each end is tested once. Groups with one distinct value, or a neighbour of zero, keep theirs;
    rows without a value stay. The limits are one row per group in a file of known size.
    """
    limits = materialise(
        extreme_limits(df, keys, value, max_pct, min_pct).filter(
            F.col("drop_at_or_above").isNotNull() | F.col("drop_at_or_below").isNotNull()
        )
    )
    v = F.col(value)
    too_high = F.coalesce(v >= F.col("drop_at_or_above"), F.lit(False))
    too_low = F.coalesce(v <= F.col("drop_at_or_below"), F.lit(False))
    return df.join(limits, list(keys), "left").filter(~too_high & ~too_low).select(*df.columns)


def harmonise(df: DataFrame, factors: DataFrame, keys: Sequence[str], value: str, unit: str) -> DataFrame:
    """Convert to the standard unit by the factor table (keys, factor, standard_unit).

    The value and unit as received stay beside the result; ``harmonised`` says if a factor was found.
    The factors are written out first, so that the join knows their size: measurements would
    otherwise be shuffled by unit, of which there are few.
    """
    known = materialise(factors.select(*keys, "factor", "standard_unit"))
    found = df.join(known, list(keys), "left")
    return (
        found.withColumn(f"raw_{value}", F.col(value))
        .withColumn(f"raw_{unit}", F.col(unit))
        .withColumn("harmonised", F.col("factor").isNotNull())
        .withColumn(value, F.col(value) * F.coalesce("factor", F.lit(1.0)))
        .withColumn(unit, F.coalesce("standard_unit", F.col(unit)))
        .drop("factor", "standard_unit")
    )


def trim(
    df: DataFrame,
    bounds: DataFrame,
    key: str,
    value: str,
    overrides: Mapping[str, tuple[float | None, float | None]] | None = None,
    missing_values: Sequence[float] = (10_000_000.0, 100_000_000.0),
    site: str | None = None,
    drop_sites: Sequence = (),
) -> DataFrame:
    """Drop values outside the bounds (key, minimum, maximum), stand-ins for missing, listed sites.

    ``overrides`` replaces the minimum, the maximum or both for a key.
    """
    low, high = F.col("minimum"), F.col("maximum")
    for name, (new_low, new_high) in (overrides or {}).items():
        low = low if new_low is None else F.when(F.col(key) == name, F.lit(float(new_low))).otherwise(low)
        high = high if new_high is None else F.when(F.col(key) == name, F.lit(float(new_high))).otherwise(high)
    limits = materialise(bounds.select(key, low.alias("_low"), high.alias("_high")))
    v = F.col(value)
    kept = df.filter(~v.isin(list(missing_values)))
    if site and drop_sites:
        kept = kept.filter(~F.col(site).isin(list(drop_sites)))
    inside = F.coalesce(v >= F.col("_low"), F.lit(True)) & F.coalesce(v <= F.col("_high"), F.lit(True))
    return kept.join(limits, key, "left").filter(inside).select(*df.columns)


def unit_distribution(df: DataFrame, keys: Sequence[str], value: str, entity: str) -> DataFrame:
    """Statistics per unit, and the entities behind them."""
    df = materialise(df.select(*keys, value, entity))
    stats = describe_by(df, keys, value, (0.25, 0.5, 0.75))
    people = df.groupBy(*keys).agg(F.count_distinct(entity).alias("n_pids"))
    return stats.join(people, list(keys))


def value_presence(df: DataFrame, entity: str, keys: Sequence[str], value: str) -> DataFrame:
    """Entities per key combination with and without a value; incomplete keys are left out."""
    state = F.when(F.col(value).isNotNull(), "has value").otherwise("no value")
    known = df.na.drop(subset=list(keys))
    return known.groupBy(*keys, state.alias("value_state")).agg(F.count_distinct(entity).alias("n_pids"))


def value_quality(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Statistics over the distinct values of every key combination."""
    return describe_by(df, keys, value, QC_PROBS, distinct=True)
