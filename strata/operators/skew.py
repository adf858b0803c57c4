"""Self-joins whose key may hold a large share of the rows.

A plain equi self-join sends every row of a group to one task, so a group of n
rows is one task with n^2 work. ``salted_self_join`` cuts a group of n rows
into s = ceil(n / chunk_rows) hash buckets and makes its pairs on an s x s
grid of cells: left rows of bucket i are copied to cells (i, 0..s-1), right
rows of bucket j to cells (0..s-1, j), and each pair meets in exactly one
cell. A cell holds about ``chunk_rows`` rows per side; a group of up to
``chunk_rows`` rows is one cell and is not copied. The plan is the same at
every size: the group sizes come from a partial count and are joined back by
the group's key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 10_000


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group, 0 if there is none: one job with partial counts."""
    sizes = df.dropna(subset=list(group)).groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def with_cells(df: DataFrame, group: Sequence[str], salt_source: str, chunk_rows: int) -> DataFrame:
    """``df`` with ``_nsalt``, its group's number of buckets, and ``_bucket``, the row's own one."""
    sizes = df.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows)).cast("int").alias("_nsalt"))
    return df.join(sizes, list(group)).withColumn(
        "_bucket", F.pmod(F.xxhash64(F.col(salt_source)), F.col("_nsalt").cast("bigint")).cast("int")
    )


def salted_self_join(
    df: DataFrame,
    group: Sequence[str],
    salt_source: str,
    condition: Column | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Inner self-join of ``df`` (aliases ``a`` and ``b``) on ``group``.

    ``condition`` may reference ``a.*`` and ``b.*``; ``salt_source`` is the
    column hashed to pick a row's bucket. Rows whose group is NULL pair with
    nothing. ``largest``: rows of the largest group, if they have been counted.
    """
    if largest is not None and largest <= chunk_rows:
        return df.alias("a").join(df.alias("b"), _same(group, condition), "inner")
    rows = with_cells(df, group, salt_source, chunk_rows)
    every = F.explode(F.sequence(F.lit(0), F.col("_nsalt") - 1))
    a = rows.withColumn("_cell_a", F.col("_bucket")).withColumn("_cell_b", every).alias("a")
    b = rows.withColumn("_cell_b", F.col("_bucket")).withColumn("_cell_a", every).alias("b")
    return a.join(b, _same([*group, "_cell_a", "_cell_b"], condition), "inner")


def _same(columns: Sequence[str], condition: Column | None) -> Column:
    """Equal in ``columns`` on both sides, with the further condition."""
    cond = F.lit(True) if condition is None else condition
    for c in columns:
        cond = (F.col(f"a.{c}") == F.col(f"b.{c}")) & cond
    return cond
