"""Count and percent text, and the hiding of small cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import scaled_half_even

MIN_CELL = 20


def count_text(n: Column) -> Column:
    """1234 as '1,234'."""
    return F.format_number(n.cast("bigint"), 0)


def pct_text(ratio: Column, digits: int = 2) -> Column:
    """0.056 as '5.60%'; rounds as Python's '%' format does. Ratios are not negative."""
    scaled = scaled_half_even(ratio * F.lit(100.0), digits)
    if digits == 0:
        return F.concat(scaled.cast("string"), F.lit("%"))
    unit = 10**digits
    whole = F.floor(scaled / unit).cast("string")
    return F.concat(whole, F.lit("."), F.lpad(F.pmod(scaled, F.lit(unit)).cast("string"), digits, "0"), F.lit("%"))


def count_pct(n: Column, ratio: Column, digits: int = 2) -> Column:
    """'1,234 (5.60%)'."""
    return F.concat(count_text(n), F.lit(" ("), pct_text(ratio, digits), F.lit(")"))


def suppressed_count(n: Column, min_cell: int = MIN_CELL) -> Column:
    """'<20' for every count under the limit, zero included."""
    return F.when(n < min_cell, F.lit(f"<{min_cell}")).otherwise(count_text(n))


def suppressed_count_pct(n: Column, ratio: Column, min_cell: int = MIN_CELL) -> Column:
    """Count and whole percent: '<20 (-)' for a small count, '(<1%)' for a small share."""
    percent = (
        F.when(n < min_cell, F.lit("-")).when(ratio < 0.01, F.lit("<1%")).otherwise(pct_text(ratio, 0))
    )
    return F.concat(suppressed_count(n, min_cell), F.lit(" ("), percent, F.lit(")"))


def suppress_cell(cell: Column, min_cell: int = MIN_CELL) -> Column:
    """Hide a finished cell by its leading count: 0 and '-' give '-', 1 to 19 give '<20'.

    Works on numbers and on text such as '1,234 (5.6%)'; doing it twice changes nothing more.
    """
    text = F.when(cell.cast("string") == "-", "0").otherwise(cell.cast("string"))
    digits = F.regexp_replace(F.split_part(text, F.lit(" ("), F.lit(1)), "[,%]", "")
    count = digits.try_cast("double")
    return F.when(count == 0, "-").when(count < min_cell, f"<{min_cell}").otherwise(text)


def split_count_pct(cell: Column) -> Column:
    """'1,234 (5.60%)' back to ``struct(count, pct)``; a '<' before the count is dropped."""
    count = F.regexp_replace(F.split_part(cell, F.lit(" ("), F.lit(1)), "[,<]", "").try_cast("bigint")
    pct = F.replace(F.split_part(cell, F.lit(" ("), F.lit(2)), F.lit("%)"), F.lit("")).try_cast("double")
    return F.struct(count.alias("count"), pct.alias("pct"))
