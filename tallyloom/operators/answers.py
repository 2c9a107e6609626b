"""Cleaning of answer columns by their distinct values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialise


def recode_distinct(df: DataFrame, column: str, clean: Callable[[Column], Column], name: str) -> DataFrame:
    """Add ``clean(column)`` as ``name``, evaluated once per distinct value.

    Cleaning runs regular expressions, which at billions of rows cost far more than the lookup. The
    values are found by a map-side combined ``distinct`` and written out; the join then knows their
    size. Null is cleaned like any other value.
    """
    raw = F.col(column)
    values = materialise(df.filter(raw.isNotNull()).select(column).distinct().withColumn("_clean", clean(raw)))
    for_null = clean(F.lit(None).cast(dict(df.dtypes)[column]))
    found = df.join(values, column, "left")
    return found.withColumn(name, F.when(raw.isNull(), for_null).otherwise(F.col("_clean"))).drop("_clean")
