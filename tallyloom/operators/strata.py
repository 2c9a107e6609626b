"""Counts by one or more person attributes for many concepts or measures at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_text, number_text, round_half_even
from ..runtime import materialise
from .shares import share

#: Columns of a wide table that are summed in one pass, few enough for generated code.
BLOCK = 100


def column_sums(
    wide: DataFrame, keys: Sequence[str], columns: Sequence[str], sums: Mapping[str, Callable[[Column], Column]], name: str
) -> DataFrame:
    """``keys``, the column's name and, for every condition in ``sums``, its number of rows that meet it.

    A wide table is never made long: blocks of columns are summed by ``keys`` with map-side combine, each reading
    its own columns alone, and only the sums are turned into rows. A table with several blocks is written first.
    """
    wide = wide.select(*keys, *[F.col(f"`{c}`") for c in columns])
    if len(columns) > BLOCK:
        wide = materialise(wide)
    parts = []
    for at in range(0, len(columns), BLOCK):
        block = columns[at : at + BLOCK]
        counts = [F.sum(F.when(met(F.col(f"`{c}`")), 1).otherwise(0)).alias(f"_{i}_{s}") for i, c in enumerate(block) for s, met in sums.items()]
        rows = [F.struct(F.lit(c).alias(name), *[F.col(f"_{i}_{s}").alias(s) for s in sums]) for i, c in enumerate(block)]
        summed = wide.select(*keys, *[F.col(f"`{c}`") for c in block]).groupBy(*keys).agg(*counts)
        parts.append(summed.select(*keys, F.explode(F.array(*rows)).alias("_row")).select(*keys, "_row.*"))
    return reduce(DataFrame.unionByName, parts)


def _by_sets(
    finest: DataFrame, fixed: Sequence[str], sets: Sequence[Sequence[str]], sums: Sequence[str], known_only: bool
) -> DataFrame:
    """Sums for every set of attributes, with the set's name in ``stratum``.

    The rows are sums by all attributes together; the sets are formed from that short
    table, so entity rows are not copied once per set. An unknown attribute is a category of its
    own (``grouping`` tells it from one left out), or with ``known_only`` keeps a row out of the set.
    """
    strata = list(dict.fromkeys(c for s in sets for c in s))
    left_out = [F.grouping(c).alias(f"_off_{c}") for c in strata]
    grouped = finest.groupingSets([[*fixed, *s] for s in sets], *fixed, *strata).agg(
        *[F.sum(name).alias(name) for name in sums], *left_out
    )
    if known_only:
        for c in strata:
            grouped = grouped.filter((F.col(f"_off_{c}") == 1) | F.col(c).isNotNull())
    name = F.concat_ws(" x ", *[F.when(F.col(f"_off_{c}") == 0, F.lit(c)) for c in strata])
    return grouped.withColumn("stratum", name).drop(*[f"_off_{c}" for c in strata])


def with_percent(counts: DataFrame, n: str = "n_pids", of: str = "numerator") -> DataFrame:
    """Add ``pct`` (two decimals) and a '1,234 (5.6%)' label."""
    pct = round_half_even(share(F.col(n), F.col(of)) * 100, 2)
    label = F.concat(count_text(F.col(n)), F.lit(" ("), number_text(F.col("pct")), F.lit("%)"))
    return counts.withColumn("pct", pct).withColumn("label", label)


def case_control_counts(
    wide: DataFrame,
    entity: str,
    concepts: Sequence[str],
    attributes: DataFrame,
    sets: Sequence[Sequence[str]],
    known_only: bool = False,
) -> DataFrame:
    """Cases and controls by attribute set, for every concept column, with their class totals.

    ``wide`` and ``attributes`` have one row per entity. They are joined once, whatever the number of
    concepts, and every concept's cases and controls are conditional sums of the joined rows.
    """
    strata = list(dict.fromkeys(c for s in sets for c in s))
    joined = wide.join(attributes.select(entity, *strata).distinct(), entity)
    classes = {"Cases": lambda c: c.cast("boolean"), "Controls": lambda c: ~c.cast("boolean")}
    both = [F.struct(F.lit(name).alias("class"), F.col(name).alias("n_pids")) for name in classes]
    summed = column_sums(joined, strata, concepts, classes, "concept")
    finest = summed.select(*strata, "concept", F.explode(F.array(*both)).alias("_class")).select(*strata, "concept", "_class.*")
    counts = _by_sets(finest.filter(F.col("n_pids") > 0), ["concept", "class"], sets, ["n_pids"], known_only)
    total = F.sum("n_pids").over(Window.partitionBy("stratum", "concept", "class"))
    return with_percent(counts.withColumn("numerator", total)).select(
        "stratum", "concept", *strata, "class", "n_pids", "numerator", "pct", "label"
    )


def measure_counts(
    wide: DataFrame,
    entity: str,
    measures: Sequence[str],
    attributes: DataFrame,
    sets: Sequence[Sequence[str]],
    denominators: Mapping[str, Sequence[str] | str],
    known_only: bool = False,
) -> DataFrame:
    """Entities with a value by attribute set, for every measure column.

    ``denominators`` says per stratum name what 100% is: 'measure' (all with a value), 'overall' (all
    joined entities, with or without a value), or the attributes of the set to hold fixed. Attributes
    are named in the order in which the sets first mention them: 'sex x ancestry'.
    """
    strata = list(dict.fromkeys(c for s in sets for c in s))
    joined = wide.join(attributes.select(entity, *strata).distinct(), entity)
    finest = column_sums(joined, strata, measures, {"n_pids": lambda c: c.isNotNull(), "_all": lambda _: F.lit(True)}, "measure")
    grouped = _by_sets(finest, ["measure"], sets, ["n_pids", "_all"], known_only)
    numerator = F.lit(None).cast("bigint")
    for stratum, of in denominators.items():
        if of == "overall":
            base = F.sum("_all").over(Window.partitionBy("stratum", "measure"))
        else:
            within = [] if of == "measure" else list(of)
            base = F.sum("n_pids").over(Window.partitionBy("stratum", "measure", *within))
        numerator = F.when(F.col("stratum") == stratum, base).otherwise(numerator)
    counts = grouped.withColumn("numerator", numerator).filter(F.col("n_pids") > 0)
    return with_percent(counts).select("stratum", "measure", *strata, "n_pids", "numerator", "pct", "label")
