"""Rows and ranks found by counting keys instead of sorting tables.

Every order column is mapped to a 64-bit number that keeps its order. Counts by the leading bits of
that number say in which bucket a wanted rank lies; only this bucket is looked at more closely, by
further bits and then by the next order column. What reaches the driver is ``2 ** BITS`` counts a step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of one step, as a power of two.
BITS = 12
#: A bucket with at most this many rows is sorted.
SORTED = 10_000
_LEAST, _MOST = -(2**63), 2**63 - 1
#: A text is looked at in pieces of so many bytes.
_PIECE, _PIECES = 7, 8


def double_key(value: Column) -> Column:
    """The bits of a double as a number that sorts as the double does; NaN is the largest, both zeros are one."""
    size = F.abs(value)
    power = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    # the logarithm may be off by one next to a power of two
    power = F.when(size < F.pow(F.lit(2.0), power), power - 1).when(size / F.pow(F.lit(2.0), power) >= 2.0, power + 1).otherwise(power)
    power = F.greatest(F.least(power, F.lit(1023)), F.lit(-1022)).cast("long")
    part = size / F.pow(F.lit(2.0), power.cast("double"))
    normal = (power + F.lit(1022)) * F.lit(2**52) + (part * F.lit(float(2**52))).cast("long")
    bits = F.when(size == 0.0, F.lit(0)).when(size == float("inf"), F.lit(2047 * 2**52)).otherwise(normal)
    return F.when(F.isnan(value), F.lit(_MOST)).when(value < 0, -bits).otherwise(bits).cast("long")


def order_keys(column: Column, kind: str, descending: bool = False) -> list[Column]:
    """Numbers that, compared one after the other, keep the order of a column; equal ones may hide a difference.

    Nulls come first, or last where the order runs downwards, as in any sort.
    """
    if kind == "string":
        pieces = [F.hex(F.substring(F.encode(column, "UTF-8"), 1 + i * _PIECE, _PIECE)) for i in range(_PIECES)]
        keys = [F.conv(F.rpad(p, 2 * _PIECE, "0"), 16, 10).cast("long") for p in pieces]
    elif kind == "date":
        keys = [F.unix_date(column).cast("long")]
    elif kind == "timestamp":
        keys = [F.unix_micros(column)]
    elif kind == "boolean" or kind in ("tinyint", "smallint", "int", "bigint"):
        keys = [column.cast("int").cast("long") if kind == "boolean" else column.cast("long")]
    elif kind in ("float", "double") or kind.startswith("decimal"):
        keys = [double_key(column.cast("double"))]
    else:
        raise TypeError(f"no order key for {kind}")
    if descending:
        return [F.coalesce(F.bitwise_not(k), F.lit(_MOST)) for k in keys]
    return [F.coalesce(k, F.lit(_LEAST)) for k in keys]


def _before(column: Column, value: object, descending: bool) -> Column:
    if value is None:
        return column.isNotNull() if descending else F.lit(False)
    smaller = F.coalesce(column > F.lit(value) if descending else column < F.lit(value), F.lit(False))
    return smaller if descending else smaller | column.isNull()


def _upto(columns: Sequence[Column], cut: Sequence[object], descending: int) -> Column:
    """Whether a row stands before ``cut`` or is equal to it."""
    out = F.lit(True)
    for i in reversed(range(len(columns))):
        out = _before(columns[i], cut[i], i < descending) | (columns[i].eqNullSafe(F.lit(cut[i])) & out)
    return out


def _bucket_of(rows: DataFrame, keys: Sequence[str], n: int) -> tuple[DataFrame, int] | None:
    """The few rows among which the ``n``-th lies, and its rank among them; None if there are at most ``n`` rows."""
    for key in keys:
        least, most, count = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        if count <= n:
            return None if key == keys[0] else (rows, n)
        while count > SORTED and least < most:
            shift = max(0, (most - least).bit_length() - BITS)
            buckets = rows.groupBy(F.shiftright(key, shift).alias("b")).agg(F.count(F.lit(1)).alias("c"), F.min(key).alias("least"), F.max(key).alias("most"))
            for bucket in sorted(buckets.collect(), key=lambda r: r.b):
                if bucket.c >= n:
                    break
                n -= bucket.c
            least, most, count = bucket.least, bucket.most, bucket.c
            rows = rows.filter(F.col(key).between(least, most))
        if count <= SORTED:
            break
    return rows, n


def nth_row(df: DataFrame, n: int, order: Sequence[Column | str], descending: int = 0) -> tuple | None:
    """The order columns of row ``n`` (from 1) of a total order; None if there is none after it.

    Each step reads the order columns alone, counts one key by its leading bits and goes on in the
    bucket of rank ``n``; at most ``SORTED`` rows are sorted, or those that are equal in all their
    keys. A joined or aggregated input should be written out first.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    narrow = df.select(*[c.alias(f"o{i}") for i, c in enumerate(columns)])
    keys = {}
    for i, (name, kind) in enumerate(narrow.dtypes):
        for j, key in enumerate(order_keys(F.col(name), kind, i < descending)):
            keys[f"k{i}_{j}"] = key
    found = _bucket_of(narrow.withColumns(keys), list(keys), n)
    if found is None:
        return None
    rows, place = found
    sort = [F.desc(c) if i < descending else F.asc(c) for i, c in enumerate(narrow.columns)]
    return tuple(rows.select(*narrow.columns).orderBy(*sort).offset(place - 1).limit(1).first())


def first_rows(df: DataFrame, n: int, order: Sequence[Column | str], descending: int = 0) -> DataFrame:
    """The first ``n`` rows of a total order, of which the first ``descending`` columns run downwards.

    Row ``n`` is found by counting (:func:`nth_row`); the result is a filter of the input by its
    order columns, without a sort, join or shuffle of the rows. The plan is the same for every ``n``. The
    input is read several times and must give the same rows every time; rows equal in all order columns come or go together.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    cut = nth_row(df, n, order, descending)
    if cut is None:
        return df
    return df.filter(_upto([F.col(c) if isinstance(c, str) else c for c in order], cut, descending))

