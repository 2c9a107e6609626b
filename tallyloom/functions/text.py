"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Capital after every non-letter, as Python's ``str.title``; ``initcap`` breaks on blanks only.

    'less 10k' becomes 'Less 10K'.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def answer_text(answer: Column) -> Column:
    """The value of a 'Stem: value' answer; '' if there is no ': ' in it."""
    stem = F.split_part(answer, F.lit(": "), F.lit(1))
    return F.replace(F.replace(answer, stem, F.lit("")), F.lit(": "), F.lit(""))


def after_stem(answer: Column) -> Column:
    """The part between the first and the second ': ', or the whole text if there is none."""
    return F.when(F.contains(answer, F.lit(": ")), F.split_part(answer, F.lit(": "), F.lit(2))).otherwise(answer)


def number_text(number: Column) -> Column:
    """A number as text without a useless '.0', for lists of values."""
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(1e15))
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))
