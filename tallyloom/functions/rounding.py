"""Rounding that agrees with the text and number rounding of Python and numpy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, cuts a double into two 26-bit halves


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Scale, round to the nearest even integer, scale back: the rule of ``numpy.round``."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def scaled_half_even(value: Column, digits: int) -> Column:
    """``value * 10**digits`` as BIGINT, rounded as ``format(value, '.Nf')`` rounds.

    Formatting rounds the exact binary value, so 1.015 (stored a little below) goes to 1.01. The
    product is therefore compared with the midpoint in two halves that both multiply exactly.
    """
    scale = F.lit(float(10**digits))
    high = value * F.lit(_SPLIT) - (value * F.lit(_SPLIT) - value)
    low = value - high
    floor = F.floor(value * scale).cast("double")
    midpoint = floor + F.lit(0.5)
    side = (high * scale - midpoint) + low * scale
    odd = F.pmod(floor, F.lit(2.0)) == F.lit(1.0)
    up = (side > 0) | ((side == 0) & odd)
    return F.when(up, floor + 1).otherwise(floor).cast("bigint")
