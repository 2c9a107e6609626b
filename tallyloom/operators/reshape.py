"""Wide and long shapes, finished tables as text, and the income threshold table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_text, pct_text, split_count_pct, suppress_cell
from ..runtime import materialise

WHOLE = ("tinyint", "smallint", "int", "bigint")
REAL = ("double", "float")


def to_wide(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, cell: str) -> DataFrame:
    """One column per listed value, missing cells 0. The list spares Spark a job to find the values."""
    wide = df.groupBy(*rows).pivot(column, list(values)).agg(F.max(cell))
    return wide.na.fill(0, [str(v) for v in values])


def threshold_dimension(
    guideline: DataFrame,
    large: DataFrame,
    sizes: tuple[int, int] = (9, 19),
    base: str = "eight_persons",
    step: str = "each_additional",
) -> DataFrame:
    """Income thresholds by year, area and household size, with the doubled threshold.

    ``guideline`` lists households up to eight (year, state, household_size, income); ``large`` has
    the amount for eight and the amount per further person, which gives the larger sizes.
    """
    small = guideline.select(
        F.col("year").cast("int").alias("year"), "state", F.col("household_size").cast("int").alias("household_size"),
        F.col("income").cast("bigint").alias("fpl"),
    )
    size = F.explode(F.sequence(F.lit(sizes[0]), F.lit(sizes[1]))).alias("household_size")
    bigger = large.select(F.col("year").cast("int").alias("year"), "state", base, step, size).select(
        "year", "state", "household_size",
        (F.col(base) + (F.col("household_size") - 8) * F.col(step)).cast("bigint").alias("fpl"),
    )
    return small.unionByName(bigger).withColumn("fpl_200", F.col("fpl") * 2)


def with_threshold(people: DataFrame, dimension: DataFrame, keys: Sequence[str] = ("year", "state", "household_size")) -> DataFrame:
    """Attach the thresholds to people with a year, area and household size.

    The dimension is written out first: its keys are few and skewed, and people should not be
    shuffled by them if it is small.
    """
    return people.join(materialise(dimension), list(keys))


def format_columns(
    df: DataFrame, counts: Sequence[str] | None = None, percents: Sequence[str] | None = None, digits: int = 1
) -> DataFrame:
    """Counts with thousands separators, shares as percent; by default all whole and all real columns."""
    kinds = dict(df.dtypes)
    counts = [c for c in df.columns if kinds[c] in WHOLE] if counts is None else counts
    percents = [c for c in df.columns if kinds[c] in REAL] if percents is None else percents
    return df.withColumns(
        {**{c: count_text(F.col(c)) for c in counts}, **{c: pct_text(F.col(c), digits) for c in percents}}
    )


def suppress_columns(df: DataFrame, columns: Sequence[str] | None = None, min_cell: int = 20) -> DataFrame:
    """Hide small cells in the given columns, or in all."""
    return df.withColumns({c: suppress_cell(F.col(c), min_cell) for c in (columns or df.columns)})


def split_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each 'count (percent)' column by two numeric ones, ``_count`` and ``_pct``."""
    parts = {c: split_count_pct(F.col(c)) for c in columns}
    return df.select(
        *[F.col(c) for c in df.columns if c not in parts],
        *[parts[c][field].alias(f"{c}_{field}") for c in columns for field in ("count", "pct")],
    )
