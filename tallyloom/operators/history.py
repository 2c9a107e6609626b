"""First-seen years, periods of data and cumulative growth per domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import round_half_even
from .shares import share
from .stats import describe_by

MICROS_PER_DAY = 86_400_000_000.0


@dataclass(frozen=True)
class Domain:
    """Where one domain keeps its records: table, extra key columns and time columns."""

    label: str
    table: str
    start: str
    end: str
    keys: Mapping[str, str]


def union_domains(tables: Mapping[str, DataFrame], domains: Sequence[Domain], entity: str) -> DataFrame:
    """All domain tables in one shape: entity, domain, keys, start, end. One plan, no loop of queries."""

    def shaped(d: Domain) -> DataFrame:
        keys = [F.col(source).alias(name) for name, source in d.keys.items()]
        return tables[d.table].select(
            entity, F.lit(d.label).alias("domain"), *keys, F.col(d.start).alias("start"), F.col(d.end).alias("end")
        )

    return reduce(DataFrame.unionByName, map(shaped, domains))


def with_any(df: DataFrame, domain: str, any_label: str) -> DataFrame:
    """Copy every row to ``any_label`` as well."""
    return df.withColumn(domain, F.explode(F.array(F.col(domain), F.lit(any_label))))


def first_seen(df: DataFrame, entity: str, domain: str, ts: str, any_label: str | None = None) -> DataFrame:
    """The earliest year of every entity per domain; with ``any_label`` also over all domains.

    Domains are merged on the per-domain result, which has one row per entity and domain.
    """
    years = df.groupBy(entity, domain).agg(F.min(F.year(ts)).alias("year"))
    if any_label is None:
        return years
    return with_any(years, domain, any_label).groupBy(entity, domain).agg(F.min("year").alias("year"))


def periods(
    df: DataFrame,
    entity: str,
    keys: Sequence[str],
    start: str,
    end: str,
    cutoff: Column,
    any_label: str | None = None,
    domain: str = "domain",
) -> DataFrame:
    """First and last date per entity and keys; an open end becomes the cutoff.

    ``any_label`` adds a de-duplicated copy of all periods under that domain.
    """
    spans = df.groupBy(entity, *keys).agg(
        F.min(start).alias("start"), F.coalesce(F.max(end), cutoff).alias("end")
    )
    return spans if any_label is None else with_any(spans, domain, any_label).distinct()


def years_of_data(spans: DataFrame, entity: str, domain: str, start: str = "start", end: str = "end") -> DataFrame:
    """Years between the first start and the last end, in whole elapsed days, at least one day."""
    ends = spans.groupBy(entity, domain).agg(F.min(start).alias("_start"), F.max(end).alias("_end"))
    days = F.abs(_elapsed_days(dict(ends.dtypes)["_start"]))
    return ends.select(entity, domain, (F.when(days == 0, 1).otherwise(days) / 365).alias("years"))


def _elapsed_days(kind: str) -> Column:
    """Whole days from ``_start`` to ``_end``, rounded down.

    Times without a zone are compared by calendar day and time of day, so no clock change of the
    session's time zone shifts them.
    """
    start, end = F.col("_start"), F.col("_end")
    if kind == "timestamp":
        return F.floor(F.timestamp_diff("MICROSECOND", start, end.cast(kind)) / MICROS_PER_DAY)
    earlier_in_day = F.date_format(end, "HHmmssSSSSSS") < F.date_format(start, "HHmmssSSSSSS")
    return F.date_diff(end, start) - F.when(earlier_in_day, 1).otherwise(0)


def years_stats(years: DataFrame, domain: str) -> DataFrame:
    """Entities and years per domain: mean, median, min, max, standard deviation, two decimals.

    ``years`` has one row per entity and domain, so rows are entities.
    """
    stats = describe_by(years, [domain], "years", (0.5,))
    rounded = {"mean": "mean", "q50": "median", "min": "min", "max": "max", "sd": "std"}
    return stats.select(domain, "n", *[round_half_even(F.col(c), 2).alias(name) for c, name in rounded.items()])


def cumulative_entities(
    df: DataFrame, entity: str, domain: str, year: str, denominator: int | DataFrame, any_label: str | None = None
) -> DataFrame:
    """Entities first seen up to each year per domain; years without newcomers stay in the series.

    An entity's year list is as short as the calendar; the running sum is over one row per year.
    """
    rows = df.filter(F.col(year).isNotNull())
    if any_label is not None:
        rows = with_any(rows, domain, any_label)
    seen = rows.groupBy(domain, entity).agg(F.min(year).alias("_first"), F.collect_set(year).alias("_years"))
    by_year = (
        seen.select(domain, "_first", F.explode("_years").alias("year"))
        .groupBy(domain, "year")
        .agg(F.sum(F.when(F.col("year") == F.col("_first"), 1).otherwise(0)).alias("n_new"))
    )
    upto = Window.partitionBy(domain).orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    size = F.lit(denominator) if isinstance(denominator, int) else denominator.scalar()
    series = by_year.withColumn("cum_n", F.sum("n_new").over(upto))
    return series.withColumn("cum_pct", round_half_even(share(F.col("cum_n"), size) * 100, 2))
