"""Activity bitmaps held in the low bits of a LONG (Spark has no BIT(n))."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col_of


def low_mask(width: int) -> int:
    return (1 << width) - 1


def top_bits_mask(n: int, width: int = 32) -> int:
    """Mask of the ``n`` highest bits of a ``width``-bit map (e.g. n=7: last week)."""
    return ((1 << n) - 1) << (width - n)


def date_bitmap(
    dates: str | Column,
    anchor: str | Column,
    width: int = 32,
    anchor_bit: int = 31,
    window_days: int | None = None,
) -> Column:
    """OR of ``1 << (anchor_bit - days_before_anchor)`` over the listed dates.

    Only dates 0 .. ``window_days - 1`` days before the anchor count
    (default ``anchor_bit + 1`` days, i.e. bit 0 = the oldest day); later
    or older dates are ignored; duplicates are harmless (OR, not SUM).
    ``anchor_bit=32, window_days=31`` reproduces the literal job: a 31-day
    series with exponent 32 - n, so the anchor day's bit falls off the map.
    Computed row-wise with ``aggregate`` -- no cross join with a date series
    and no group-by.
    """
    if window_days is None:
        window_days = anchor_bit + 1
    a = col_of(anchor)
    lag = lambda d: F.datediff(a, d)
    in_range = F.filter(col_of(dates), lambda d: (lag(d) >= 0) & (lag(d) < F.lit(window_days)))
    bits = F.aggregate(
        in_range,
        F.lit(0).cast("bigint"),
        lambda acc, d: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(anchor_bit) - lag(d))),
    )
    return bits.bitwiseAND(F.lit(low_mask(width)))


def bit_string(bits: str | Column, width: int = 32) -> Column:
    return F.lpad(F.bin(col_of(bits)), width, "0")


def any_bits(bits: str | Column, mask: int) -> Column:
    return col_of(bits).bitwiseAND(F.lit(mask)) != 0
