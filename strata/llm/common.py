"""Column helpers shared by the operators of this package."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import state_path

# The blank characters (space, tab to carriage return) and the
# character class that separates words made of letters, digits and non-ASCII.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
NON_WORD_RUN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ARROW_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay. Pure ASCII texts take the byte-wise path."""
    upper = string.ascii_uppercase
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def blank_words(text: Column) -> Column:
    """Array of the runs of non-blank characters; empty for NULL or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def alnum_words(text: Column) -> Column:
    """Array of lower-cased words of letters, digits and non-ASCII characters; empty for NULL."""
    pieces = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NON_WORD_RUN)
    return F.array_remove(pieces, "")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """With the doc_id itself, the key of a document: it tells apart rows sharing (or lacking) a doc_id."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def join_documents(rows: DataFrame, found: DataFrame, how: str, key: str = "_key", doc_id: str = "doc_id") -> DataFrame:
    """Join what was found per document (``_key``, ``doc_id``) to rows with these two columns; NULL ids match."""
    side = found.withColumnsRenamed({"_key": "_found_key", "doc_id": "_found_id"})
    same = (F.col(key) == F.col("_found_key")) & F.col(doc_id).eqNullSafe(F.col("_found_id"))
    return rows.join(side, same, how).drop("_found_key", "_found_id")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = state_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_arrow_batches(spark: SparkSession) -> None:
    """Let Spark hand Arrow batches of about ``ARROW_BYTES`` to Python, unless the session has set a bound itself.

    Spark reads the setting when the query runs, so it stays for the session;
    it changes no result. Spark's own bound of 64 MB is held once or twice by
    each worker and, while it is built, by the JVM.
    """
    if spark.conf.get(ARROW_BOUND, None) is None:
        spark.conf.set(ARROW_BOUND, str(ARROW_BYTES))


def parts(text, size: int = 1 << 20) -> Iterator:
    """A long text (str or bytes) in pieces of about ``size``, cut before a blank: no word is cut."""
    blank = re.compile(r"[\x20\x09-\x0D]" if isinstance(text, str) else rb"[\x20\x09-\x0D]")
    at = 0
    while at < len(text):
        cut = blank.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
