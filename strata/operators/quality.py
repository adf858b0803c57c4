"""Grain checks, deterministic dedup and period bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_list(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def grain_counts(df: DataFrame, keys: str | Sequence[str], count_col: str = "num_rows") -> DataFrame:
    """Rows per key (the reference's ``GROUP BY keys`` + ``COUNT(1)``)."""
    keys = _as_list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def grain_check(df: DataFrame, keys: str | Sequence[str], count_col: str = "num_rows") -> DataFrame:
    """Keys that occur more than once: empty output means ``keys`` is the grain.

    A hash aggregate with map-side partial counts, so a key holding a large
    share of the rows costs one counter per task, not one huge group.
    """
    return grain_counts(df, keys, count_col).where(F.col(count_col) > 1)


def dedup_first(
    df: DataFrame, keys: str | Sequence[str], order: str | Column | Sequence[str | Column]
) -> DataFrame:
    """Keep the first row per key under a total ``order`` (plain names sort ascending, NULLs first).

    ``row_number() == 1`` over (keys ordered by ``order``): Spark plans it as a
    WindowGroupLimit that runs *partially before the shuffle* (each task keeps
    only its best row per key) and finally after it, so a hot key shrinks to
    one candidate per task and no task sorts a whole skewed group. The
    caller supplies an order that makes ties impossible (or only ties between
    identical rows), which keeps the result deterministic.
    """
    keys = _as_list(keys)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def period_bounds(df: DataFrame, period: str, lo: str = "min_period", hi: str = "max_period") -> DataFrame:
    """Global first and last period (the seed and the end of a backfill)."""
    return df.agg(F.min(period).alias(lo), F.max(period).alias(hi))


def bounds_of(df: DataFrame, period: str) -> tuple:
    """(min, max) of ``period`` as Python scalars: one tiny aggregate row."""
    row = period_bounds(df, period).first()
    return row[0], row[1]
