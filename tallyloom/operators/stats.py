"""Distribution statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import number_text
from ..runtime import materialise
from .quantiles import describe_values, values_of

REPORT_PROBS = (0.01, 0.02, 0.25, 0.5, 0.75, 0.98, 0.99)


def quantile_name(p: float) -> str:
    return f"q{round(p * 100):02d}"


def describe_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float] = REPORT_PROBS,
    distinct: bool = False,
    exact: bool = True,
    pin: bool = False,
) -> DataFrame:
    """n, mean, min, max, sd and quantiles per group; ``keys=[]`` describes the whole column.

    ``distinct`` describes the distinct values instead. ``exact=False`` takes the quantiles from a
    sketch in the same single pass. ``pin`` writes the key and value columns out first: exact
    quantiles read their input twice, which a joined input should not be made to.
    """
    rows = _input(df, keys, value, distinct, pin and exact)
    if exact:
        described = describe_values(rows, keys, quantiles)
    else:
        described = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"),
            F.stddev_samp("_v").alias("sd"), F.percentile_approx("_v", list(quantiles), 10_000).alias("q"),
        )
    named = [F.col("q")[i].alias(quantile_name(p)) for i, p in enumerate(quantiles)]
    return described.select(*keys, "n", "mean", "min", "max", *named, "sd")


def _input(df: DataFrame, keys: Sequence[str], value: str, distinct: bool, pin: bool) -> DataFrame:
    rows = values_of(df, keys, value)
    if distinct:
        return materialise(rows.distinct())
    return materialise(rows) if pin else rows


def box_stats(
    df: DataFrame, keys: Sequence[str], value: str, distinct: bool = False, pin: bool = False
) -> DataFrame:
    """Quartiles, mean, and the outermost values within 1.5 times the quartile range."""
    rows = _input(df, keys, value, distinct, pin)
    quartiles = materialise(
        describe_values(rows, keys, (0.25, 0.5, 0.75)).select(
            *keys, "n", "mean", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
        )
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quartiles.select(*keys, (F.col("q1") - reach).alias("_from"), (F.col("q3") + reach).alias("_to"))
    if keys:
        near = rows.join(fences, list(keys))
    else:
        near = rows.withColumns({c: fences.select(c).scalar() for c in ("_from", "_to")})
    ends = near.filter(F.col("_v").between(F.col("_from"), F.col("_to"))).groupBy(*keys).agg(
        F.min("_v").alias("whisker_low"), F.max("_v").alias("whisker_high")
    )
    if keys:
        return quartiles.join(ends, list(keys))
    return quartiles.withColumns({c: ends.select(c).scalar() for c in ends.columns})


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the smallest and the largest value per group.

    The last bin includes its upper end; empty bins are listed with 0.
    """
    keys = list(keys)
    rows = values_of(df, keys, value)
    ends = materialise(rows.groupBy(*keys).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max")))
    width = F.col("_max") - F.col("_min")
    place = F.floor(F.try_divide(F.col("_v") - F.col("_min"), width) * bins) + 1
    if keys:
        spread = rows.join(ends, keys)
    else:
        spread = rows.withColumns({c: ends.select(c).scalar() for c in ("_min", "_max")})
    counts = (
        spread.groupBy(*keys, F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ends.filter(F.col("_min").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    low = F.col("_min") + (F.col("bin") - 1) * width / bins
    high = F.col("_min") + F.col("bin") * width / bins
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys, "bin", low.alias("lo"), high.alias("hi"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def pretty_histogram(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Histogram over round breaks: about log2(n) + 1 bins, right-closed, the lowest value included.

    Breaks are multiples of 1, 2, 5 or 10 times a power of ten that cover the range, the usual
    default of statistical plots.
    """
    keys = list(keys)
    rows = values_of(df, keys, value)
    facts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    ).filter(F.col("_n") > 0)
    wanted = F.ceil(F.log2("_n") + 1)
    span = F.col("_max") - F.col("_min")
    rough = F.when(span > 0, span / wanted).otherwise(F.greatest(F.abs(F.col("_max")), F.lit(1.0)) / wanted)
    power = F.pow(F.lit(10.0), F.floor(F.log10(rough)))
    lead = rough / power
    # A larger step is taken once the rough one is past the biased midpoint between the two.
    step = power * (
        F.when(10 - lead < 1.5 * (lead - 5), 10.0)
        .when(5 - lead < 2.75 * (lead - 2), 5.0)
        .when(2 - lead < 1.5 * (lead - 1), 2.0)
        .otherwise(1.0)
    )
    grid = materialise(
        facts.withColumn("_step", step)
        .withColumn("_from", F.floor(F.col("_min") / F.col("_step") + 1e-7))
        .withColumn("_to", F.greatest(F.ceil(F.col("_max") / F.col("_step") - 1e-7), F.col("_from") + 1))
        .select(*keys, "_step", "_from", "_to")
    )
    if keys:
        placed = rows.join(grid, keys)
    else:
        placed = rows.withColumns({c: grid.select(c).scalar() for c in ("_step", "_from")})
    slot = F.greatest(F.ceil(F.col("_v") / F.col("_step") - 1e-7) - F.col("_from"), F.lit(1)).cast("int")
    counts = placed.groupBy(*keys, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    numbers = F.sequence(F.lit(1), (F.col("_to") - F.col("_from")).cast("int"))
    bins = grid.select(*keys, "_step", "_from", F.explode(numbers).alias("bin"))
    return bins.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        ((F.col("_from") + F.col("bin") - 1) * F.col("_step")).alias("lo"),
        ((F.col("_from") + F.col("bin")) * F.col("_step")).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def latest(df: DataFrame, entity: str, ts: str, columns: Sequence[str], ties: str = "first") -> DataFrame:
    """The newest value of every entity.

    ``first``: one row, of several at the same time the largest. ``all``: every value at that time,
    ordered, joined by ', '. The newest time comes from a map-side combined maximum, and rows meet it
    by (entity, time), so an entity with very many rows is spread over its times. Equal values are
    counted before they are gathered, so a reading that repeats is one entry until the text is made.
    """
    present = df.filter(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    if ties == "first":
        largest, *others = columns
        if not others:  # both steps keep fixed-width buffers, so neither sorts the rows
            by_time = present.groupBy(entity, ts).agg(F.max(largest).alias(largest))
            return by_time.groupBy(entity).agg(F.max_by(largest, ts).alias(largest))
        newest = F.max(F.struct(ts, *columns)).alias("_newest")
        return present.groupBy(entity).agg(newest).select(entity, *[F.col(f"_newest.{c}").alias(c) for c in columns])
    newest_time = present.groupBy(entity).agg(F.max(ts).alias(ts))
    newest = (
        present.select(entity, ts, *columns).join(newest_time, [entity, ts])
        .groupBy(entity, *columns).agg(F.count(F.lit(1)).cast("int").alias("_times"))
        .groupBy(entity).agg(F.array_sort(F.collect_list(F.struct(*columns, "_times"))).alias("_kinds"))
        .withColumn("_values", F.flatten(F.transform("_kinds", lambda kind: F.array_repeat(kind, kind["_times"]))))
    )
    types = dict(df.dtypes)

    def joined(column: str) -> Column:
        def text(item: Column) -> Column:
            return number_text(item[column]) if types[column] in ("double", "float") else item[column].cast("string")

        return F.array_join(F.transform("_values", text), ", ", "NA").alias(column)

    return newest.select(entity, *[joined(c) for c in columns])


def distinct_list(df: DataFrame, entity: str, column: str, name: str) -> DataFrame:
    """The distinct values of an entity as one sorted text; meant for short code lists such as units."""
    return df.groupBy(entity).agg(F.array_join(F.array_sort(F.collect_set(column)), ", ").alias(name))


def entity_summary(
    df: DataFrame,
    entity: str,
    value: str,
    ts: str,
    unit: str,
    quantiles: Sequence[float] = REPORT_PROBS,
    pin: bool = False,
) -> DataFrame:
    """Per entity: statistics, all values and units at the newest time, number of distinct values.

    ``pin`` writes the four columns out first, as they are read several times.
    """
    df = materialise(df.select(entity, value, ts, unit)) if pin else df
    rows = values_of(df, [entity], value)
    described = describe_values(rows, [entity], quantiles, distinct_values=True)
    named = [F.col("q")[i].alias(quantile_name(p)) for i, p in enumerate(quantiles)]
    newest = latest(df, entity, ts, [value, unit], ties="all").select(
        entity, F.col(value).alias("latest_value"), F.col(unit).alias("latest_value_unit")
    )
    return (
        described.select(entity, "mean", "min", "max", *named, "sd", F.col("n_distinct").alias("values_count"))
        .join(newest, entity)
    )


def entity_range(
    df: DataFrame, entity: str, value: str, ts: str, unit: str, pin: bool = False
) -> DataFrame:
    """Per entity: min, median, max, mean, count, list of units, one newest value."""
    df = materialise(df.select(entity, value, ts, unit)) if pin else df
    described = describe_values(values_of(df, [entity], value), [entity], (0.5,))
    stats = described.select(entity, "min", F.col("q")[0].alias("median"), "max", "mean", F.col("n").alias("count"))
    units = distinct_list(df, entity, unit, "units")
    newest = latest(df, entity, ts, [value]).select(entity, F.col(value).alias("latest"))
    return stats.join(units, entity).join(newest, entity)
