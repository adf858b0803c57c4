"""Substring dedup by hashing of text units, original offsets retained.

Units are lines, cut further after a sentence end (``.``, ``!`` or ``?``) that
a blank follows: numbers, addresses and versions stay whole. A unit is
normalised (lower case, words only, single blanks) and hashed to 128 bits. Units
are grouped by digest over all documents: per digest, a partial aggregate keeps
the earliest ranked occurrence (smallest doc_id, then offset) and whether there
is another. Every other occurrence is a repeat. Adjacent repeats of a document
form a run. A run is removed if its words have at least ``min_bytes`` bytes, or
if it fills a line and has ``line_bytes``: a few words that stand in many
sentences by chance stay, a repeated line goes.

Scale. Digests are shuffled, not texts, and counted before the shuffle. The
join of the units with the repeated digests is a plain equi-join, which
adaptive execution may split where one unit stands in very many documents. A
document's own repeats are ordered in one window per document.

Defined results: NULL and blank texts have no unit; rows without doc_id rank
last; rows equal in doc_id and text are one document (neither repeats the
other, and each gets the same spans); extra columns are ignored by ``repeats``
and passed through by ``remove_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_documents, row_key, stored

UNIT = re.compile(r"(?:[^\n.!?]+|[.!?](?![ \t\x0b\x0c\r]))+[.!?]?|[.!?]")
WORD = re.compile(r"\w+")


def units(docs: DataFrame) -> DataFrame:
    """The units with words: doc_id, _key, n, start, stop, n_words, n_bytes, opens, closes, d1, d2.

    ``n`` counts a document's units, ``n_bytes`` the bytes of the words; ``opens`` and ``closes`` mark a line's
    first and last unit; d1 and d2 are the halves of the digest.
    """
    names = "doc_id _key n start stop n_words n_bytes opens closes d1 d2".split()
    types = [pa.int64(), *[pa.int32()] * 5, pa.bool_(), pa.bool_()]

    def batch(rows: list[list], digests: list[bytes], kind: pa.DataType) -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        cols = list(zip(*rows, strict=True))
        arrays = [pa.array(c, t) for c, t in zip(cols, [kind, *types], strict=True)]
        arrays += [pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for b in batches:
            rows, digests = [], []
            kind = b.column("doc_id").type
            for doc_id, key, value in zip(b.column("doc_id").to_pylist(), b.column("_key").to_pylist(), b.column("text"), strict=True):
                text = value.as_py() or ""
                n, last = 0, 0  # last: where the last unit with words ends
                for m in UNIT.finditer(text):
                    words = WORD.findall(m.group().lower())
                    if not words:
                        continue
                    plain = " ".join(words).encode()
                    opens = n == 0 or text.find("\n", last, m.start()) >= 0
                    if opens and n:
                        rows[-1][-1] = True  # the line before is closed
                    if len(rows) >= 16384:
                        # the last row may still be closed by the next unit
                        yield batch(rows[:-1], digests[:-1], kind)
                        rows, digests = rows[-1:], digests[-1:]
                    rows.append([doc_id, key, n, m.start(), m.end(), len(words), len(plain) - len(words) + 1, opens, False])
                    digests.append(digest(plain))
                    n, last = n + 1, m.end()
                if n:
                    rows[-1][-1] = True
            if rows:
                yield batch(rows, digests, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", row_key().alias("_key")).mapInArrow(
        run,
        f"doc_id {kind}, _key bigint, n int, start int, stop int, n_words int, n_bytes int, "
        "opens boolean, closes boolean, d1 bigint, d2 bigint",
    )


def repeats(docs: DataFrame, min_bytes: int = 60, line_bytes: int = 30) -> DataFrame:
    """Spans to remove: doc_id, _key, start, stop, n_words, and where the span's first unit occurs first."""
    every = stored(units(docs), "text-units")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_key"), F.col("start"))
    # stored, so that the join below has two shuffles of its own and a hot digest's side can be split
    again = stored(
        every.groupBy("d1", "d2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(
            "d1",
            "d2",
            F.col("first.doc_id").alias("first_doc_id"),
            F.col("first._key").alias("first_key"),
            F.col("first.start").alias("first_start"),
        ),
        "text-repeats",
    )
    copies = (
        every.join(again, ["d1", "d2"])
        .where(
            (F.col("_key") != F.col("first_key"))
            | ~F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
            | (F.col("start") != F.col("first_start"))
        )
        .drop("d1", "d2", "first_key")
    )
    # repeated rows of a document bring each repeat again: the partial step drops these before the shuffle
    once = copies.dropDuplicates(["_key", "doc_id", "n"])
    # neighbouring repeats of a document share n minus their rank
    run = F.col("n") - F.row_number().over(W.partitionBy("_key", "doc_id").orderBy("n"))
    return (
        once.withColumn("run", run)
        .groupBy("_key", "doc_id", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.sum("n_words").alias("n_words"),
            F.sum("n_bytes").alias("n_bytes"),
            F.min(F.when(F.col("opens"), F.col("n"))).alias("opened"),
            F.max(F.when(F.col("closes"), F.col("n"))).alias("closed"),
            F.min(F.struct("n", "first_doc_id", "first_start")).alias("first"),
        )
        .where(
            (F.col("n_bytes") >= min_bytes) | ((F.col("opened") <= F.col("closed")) & (F.col("n_bytes") >= line_bytes))
        )
        .select("doc_id", "_key", "start", "stop", "n_words", "first.first_doc_id", "first.first_start")
    )


def remove_repeats(docs: DataFrame, min_bytes: int = 60, line_bytes: int = 30) -> DataFrame:
    """The input's own columns, with the repeated spans cut out of ``text``."""
    cuts = (
        repeats(docs.select("doc_id", "text"), min_bytes, line_bytes)
        .groupBy("_key", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("cuts"))
    ).hint("shuffle_hash")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("_row_key"))
    joined = join_documents(rows, cuts, "left", "_row_key", "row.doc_id")
    # what is left: from each cut's end to the next cut's start
    ends = F.concat(F.array(F.lit(0)), F.col("cuts.stop"))
    next_starts = F.concat(F.col("cuts.start"), F.array(F.char_length("row.text")))
    left = F.zip_with(ends, next_starts, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(
        F.array_join(
            F.transform(left, lambda x: F.col("row.text").substr(x["a"] + 1, x["b"] - x["a"])), ""
        )
    )
    return joined.withColumn("_text", text).select(
        *[(F.col("_text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]
    )
