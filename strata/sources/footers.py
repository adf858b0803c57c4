"""Counts and bounds of stored Parquet tables, answered from file footers.

Each Parquet file ends with the row count and the smallest and largest value
of each of its columns. Read through the second version of the data source
interface, Spark pushes ``count``, ``min`` and ``max`` -- also per partition
folder -- down to these footers: a scan task reads a few kilobytes per file,
whatever the table's size, and one row per file and group meets in the
exchange.

Footers answer for numbers, booleans and dates. Text has cut bounds and
timestamps may have none; asking for these is an error instead of a full scan.
An empty table has NULL bounds, no group, and a total of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructType,
)

from ..operators.quality import period_bounds

ANSWERED = (BooleanType, ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans take aggregates; the caller's settings stay as they are."""
    other = spark.newSession()
    v1 = [s for s in other.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def _open(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame:
    reader = footer_session(spark).read
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def footer_bounds(
    spark: SparkSession,
    path: str,
    column: str,
    lo: str = "min_period",
    hi: str = "max_period",
    schema: StructType | None = None,
) -> DataFrame:
    """First and last value of ``column`` from the footers alone, one row.

    Running it fails if a file's footer has no bounds: the column is NULL (or
    a number column is NaN somewhere) in all of the file.
    """
    table = _open(spark, path, schema)
    if not isinstance(dtype := table.schema[column].dataType, ANSWERED):
        raise TypeError(f"footers hold no exact bounds of {column}: {dtype.simpleString()}")
    return table.agg(F.min(column).alias(lo), F.max(column).alias(hi))


def stored_bounds(
    spark: SparkSession,
    path: str,
    column: str,
    lo: str = "min_period",
    hi: str = "max_period",
    schema: StructType | None = None,
) -> DataFrame:
    """O22 on a stored table: ``footer_bounds``, or a scan of the one column where a footer has no bounds."""
    found = footer_bounds(spark, path, column, lo, hi, schema)
    try:
        row = found.first()
    except (Py4JJavaError, PySparkException) as e:
        if "No min/max found" not in str(e):
            raise
        reader = spark.read if schema is None else spark.read.schema(schema)
        return period_bounds(reader.parquet(path), column, lo, hi)
    return spark.createDataFrame([row], found.schema)


def stored_counts(
    spark: SparkSession,
    path: str,
    partition_cols: Sequence[str] = (),
    count_col: str = "num_rows",
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of a stored table, per value of its partition columns (all rows if none are given)."""
    table = _open(spark, path, schema)
    counts = table.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias(count_col))
    # a pushed count is a sum of counts, NULL over no file; coalesce would be optimized away over a count
    return counts.select(*partition_cols, F.greatest(count_col, F.lit(0).cast("bigint")).alias(count_col))
