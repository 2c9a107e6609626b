"""Totals and shares for finished report tables, and lookups in fixed lists.

Everything here works on tables that are small by construction: one row per flag, category, year or
combination of a handful of keys. Nothing here may be fed entity rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def share(n: Column, total: Column) -> Column:
    """``n / total``; 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(n.cast("double"), total.cast("double")), F.lit(0.0))


def share_of_sum(report: DataFrame, n: str = "n", keys: Sequence[str] = (), name: str = "ratio") -> DataFrame:
    """Add each row's share of the sum of ``n`` within ``keys``."""
    total = F.sum(n).over(Window.partitionBy(*(keys or [F.lit(1)])))
    return report.withColumn(name, share(F.col(n), total))


def total_and_share(
    report: DataFrame, label: str, text: str = "TOTAL", keys: Sequence[str] = (), size: str | None = None
) -> DataFrame:
    """Append per ``keys`` a row with the sum of ``n``, and add ``ratio``, the share of the size.

    The size is a column that holds one value per ``keys``, or the sum of ``n``. The total is the sum
    of the rows, so it repeats entities that are in several of them. Each row is doubled and the
    copies summed, which reads the report once instead of twice.
    """
    keys = list(keys)
    if size is None:
        size = "_size"
        report = report.withColumn(size, F.sum("n").over(Window.partitionBy(*(keys or [F.lit(1)]))))
    others = [c for c in report.columns if c not in (*keys, label, "n", size)]
    as_is, as_total = (
        F.struct(F.lit(total).alias("_total"), name.alias("_label"), *[value(c).alias(c) for c in others])
        for total, name, value in (
            (False, F.col(label), F.col), (True, F.lit(text), lambda c: F.lit(None).cast(dict(report.dtypes)[c])),
        )
    )
    doubled = report.select(*keys, "n", F.col(size).alias("_size"), F.explode(F.array(as_is, as_total)).alias("_row"))
    summed = doubled.groupBy(*keys, "_row").agg(F.sum("n").alias("n"), F.max("_size").alias("_size"))
    return summed.select(
        *keys, F.col("_row._label").alias(label), *[F.col(f"_row.{c}").alias(c) for c in others], "n",
        share(F.col("n"), F.col("_size")).alias("ratio"),
    )


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of literal rows (category orders, bounds).

    Made from an Arrow table it is a local relation, whose size Catalyst knows; from a list of
    tuples it would count as endless and be joined by sorting.
    """
    fields = StructType.fromDDL(schema)
    columns = {field.name: [row[i] for row in rows] for i, field in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), fields)


def position(value: Column, order: Sequence[str], exact: bool = True) -> Column:
    """1-based place of a value in a fixed list, null if it is not listed.

    With ``exact=False`` the first entry that occurs in the value counts, whatever the case.
    """
    if exact:
        places = F.array_position(F.array(*[F.lit(v) for v in order]), value)
        return F.when(places > 0, places.cast("int"))
    hits = [F.when(F.contains(F.lower(value), F.lit(v.lower())), F.lit(i + 1)) for i, v in enumerate(order)]
    return F.coalesce(*hits)


def order_columns(df: DataFrame, first: Sequence[str], order: Sequence[str], separator: str = "__") -> DataFrame:
    """Select ``first``, then the ``key__rest`` columns group by group in the order of the keys.

    As in the reports, a column whose key is not listed is left out.
    """
    named = [c for key in order for c in df.columns if c.split(separator)[0] == key and c not in first]
    return df.select(*first, *[F.col(f"`{c}`") for c in named])
