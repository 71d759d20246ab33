"""Rounding rules of the wire format and of the report tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_cents(x: Column) -> Column:
    """Two decimals by the number's exact binary value, ties to even.

    ``bround`` works on the shortest decimal text, so it misjudges a number such as
    2.675, whose binary value lies just below the tie. For those the sign of the
    rest ``1000 x - tie`` decides; splitting x at 2^-10 keeps each product exact.
    """
    even = F.bround(x, 2)
    tie = F.rint(x * 1000)
    is_tie = (F.bround(x, 3) == x) & (F.pmod(tie, F.lit(10.0)) == 5.0)
    high = F.floor(x * 1024) / 1024.0
    rest = (high * 1000 - tie) + (x - high) * 1000
    # Integer hundredths first: one division by 100 then gives the nearest double.
    low_cents = F.floor(tie / 10).cast("double")
    fixed = F.when(rest < 0, low_cents / 100).when(rest > 0, (low_cents + 1) / 100).otherwise(even)
    return F.when(is_tie, fixed).otherwise(even)


def round_table(x: Column, digits: int) -> Column:
    """Scale, round half to even, scale back: the rule of the report tables."""
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def plain_decimal(x: Column) -> Column:
    """Text of a number with at most two decimals: 60.0, 72.8, 95.64; never 1.2E7."""
    return F.regexp_replace(x.cast("decimal(38,2)").cast("string"), "0$", "")
