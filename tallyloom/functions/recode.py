"""Recoding, cleaning and banding of category columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import after_stem, title_case


def recode(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the listed values, keep all others."""
    if not mapping:
        return value
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, value), value)


def strip_parts(text: Column, parts: Iterable[str]) -> Column:
    """Remove every occurrence of each part, one after the other."""
    return reduce(lambda t, part: F.replace(t, F.lit(part), F.lit("")), parts, text)


def clean_answer(
    value: Column,
    collapse: str = "none of these",
    refused: Sequence[str] = (),
    names: Mapping[str, str] | None = None,
    missing: str = "not specified",
) -> Column:
    """Missing, catch-all and refused answers to one label each, then title case, then renames."""
    known = F.coalesce(value, F.lit(missing))
    folded = (
        F.when(F.contains(known, F.lit(collapse)), F.lit(collapse))
        .when(known.isin(list(refused)), F.lit(missing))
        .otherwise(known)
    )
    return recode(title_case(folded), names or {})


def clean_answer_stem_last(value: Column, names: Mapping[str, str] | None = None) -> Column:
    """The variant for answers already collapsed on their raw text: drop the stem, title case, rename."""
    return recode(title_case(after_stem(value)), names or {})


def band(value: Column, edges: Sequence[float], labels: Sequence[str], below: str = "null") -> Column:
    """Right-closed bands: ``edges[i] < value <= edges[i + 1]``; the last label has no upper end.

    ``edges`` holds the lower end of every band, the lowest included. Values under the lowest edge
    are null, or fall into the first band with ``below="first"``.
    """
    if len(edges) != len(labels):
        raise ValueError("one lower edge per label")
    ladder = None
    for edge, label in reversed(list(zip(edges[1:], labels[1:]))):
        ladder = F.when(value > edge, label) if ladder is None else ladder.when(value > edge, label)
    first = F.lit(labels[0])
    lowest = value.isNotNull() if below == "first" else value >= edges[0]
    return F.when(lowest, first) if ladder is None else ladder.when(lowest, first)


def yes_no(rule: Column) -> Column:
    """'yes' where the rule is true, 'no' where it is false or unknown."""
    return F.when(rule, "yes").otherwise("no")


def any_of(flags: Sequence[Column]) -> Column:
    """'yes' if one of the yes/no columns is 'yes'."""
    return yes_no(reduce(lambda a, b: a | b, [flag == "yes" for flag in flags]))
