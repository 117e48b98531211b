"""Column expressions shared by the operators. All run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_UNITS = 10_000  # money is summed in ten-thousandths, so sums do not depend on order
MICROS_PER_DAY = 86_400_000_000


#: White space of Unicode.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Remove any white space of Unicode at both ends; ``trim`` alone would remove only blanks, and a pattern is much slower."""
    return F.btrim(c, F.lit(WHITE))


def null_if_in(c: Column, tokens: list[str]) -> Column:
    return F.when(~c.isin(tokens), c)


def money(c: Column) -> Column:
    """Exact integer units of an amount; anything finer than 1/10000 is rounded."""
    return F.rint(c * MONEY_UNITS).cast("long")


def from_money(c: Column) -> Column:
    return c / F.lit(float(MONEY_UNITS))


def floor_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, rounded toward minus infinity."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(float(MICROS_PER_DAY)))


def clip(c: Column, lower=None, upper=None) -> Column:
    """Limit to [lower, upper]; null stays null (``least``/``greatest`` skip nulls)."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives null for a zero denominator also in ANSI mode."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def squared_distance(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [(x - y) * (x - y) for x, y in zip(left, right)])


def most_common(value: Column, n: Column) -> Column:
    """Aggregate over (value, count) rows: the value with the highest count, ties to the
    smallest value, nulls ignored."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-n, value)))


def fixed_decimal_text(c: Column) -> Column:
    """Text with one decimal, rounded as the exact binary value (ties to even).

    ``10*x`` is split into its rounded value and the rounding error, which decides
    apparent ties such as 2.45.
    """
    scaled = c * 8 + c * 2
    error = c * 2 - (scaled - c * 8)
    tie = (scaled - F.floor(scaled)) == 0.5
    rounded = (
        F.when(tie & (error > 0), F.ceil(scaled).cast("double"))
        .when(tie & (error < 0), F.floor(scaled).cast("double"))
        .otherwise(F.rint(scaled))
    )
    return F.when(c.isNotNull(), F.format_string("%.1f", rounded / 10))


def whole_text(c: Column) -> Column:
    """Text without decimals, ties to even."""
    return F.when(c.isNotNull(), F.format_string("%.0f", F.rint(c)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
