"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints. A text is lower-cased (A-Z), cut into words at blanks and into
shingles of ``shingle`` words, repeats included (a shorter text is one
shingle). Bit i of the 64-bit fingerprint is set if it is set in more than half
of the shingles' XXH64 hashes; a text without words has fingerprint zero.

Covering masks. Bit position i gets a non-zero vector m(i) of ``radius`` + 1
bits. For each non-zero v, mask v keeps the positions whose m(i) has odd parity
with v. For any ``radius`` positions some v is orthogonal to all their vectors
(more unknowns than equations), so its mask keeps none of them: every pair of
fingerprints within the radius agrees under some mask. There are
2^(radius + 1) - 1 masks of about 32 kept bits; no pair is missed.

Linking. Equal fingerprints are merged first, whatever their number. Rows of
(mask, masked fingerprint) are dealt out and sorted by it; a run of equal keys
is compared in memory and leaves a spanning forest of its links, not its pairs.
A run beyond ``block`` fingerprints leaves its task cut into blocks, and every
two blocks meet in one task of their own, so no task holds more than two
blocks. Components come from alternating large-star and small-star steps over
the forests, written to the shared folder each round.

Defined results: NULL text counts as empty; a component's id is its smallest
non-NULL doc_id (NULL if it has none); each input row gives one row, repeated
rows included; extra columns are ignored by ``near_duplicates`` and passed
through by ``keep_one``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_documents, parts, row_key, stored

BITS = 64
SEED = 42
LEAST_FILES = 8  # of a step's edges
FILE_ROWS = 100_000


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of the space-joined shingles of the words (of all words, if they are fewer)."""
    import xxhash

    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of UTF-8 text; long texts are taken in pieces."""
    count, n, tail, seen = np.zeros(BITS, np.int64), 0, [], 0
    for part in parts(text):
        own = part.lower().split()
        seen += len(own)
        tail += own
        if len(tail) < shingle:
            continue
        hashes = _shingle_hashes(tail, shingle)
        rows = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for at in range(0, len(rows), 65536):
            count += np.unpackbits(rows[at : at + 65536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
        tail = tail[len(tail) - shingle + 1 :]
    if 0 < seen < shingle:
        hashes, n = _shingle_hashes(tail, shingle), 1
        count += np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little")
    bits = np.packbits(2 * count > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, _key, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            fp = pa.array([fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_key"), fp], ["doc_id", "_key", "fp"])

    rows = docs.select("doc_id", "text", row_key().alias("_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, _key bigint, fp bigint")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1)-1 masks such that any ``radius`` positions are outside one of them; as signed 64-bit."""
    top = (1 << (radius + 1)) - 1
    vectors = [i % top + 1 for i in range(BITS)]
    masks = []
    for v in range(1, top + 1):
        kept = sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        masks.append(kept - (1 << BITS) if kept >> (BITS - 1) else kept)
    return masks


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between distinct fingerprints within ``radius`` bits of each other."""
    if len(values) == 2:
        a, b = map(int, values)
        return [(a, b)] if ((a ^ b) & ((1 << BITS) - 1)).bit_count() <= radius else []
    links, left = [], values
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            u = queue.pop()
            near = np.bitwise_count((left ^ u).view(np.uint64)) <= radius
            if near.any():
                found, left = left[near], left[~near]
                links += [(int(u), int(x)) for x in found]
                queue += list(found)
    return links


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, fingerprints) of sorted batches: those of a key come in one or more parts."""
    for b in batches:
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        fp = b.column("fp").to_numpy(zero_copy_only=False)
        if not len(fp):
            continue
        change = np.zeros(len(fp) - 1, bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(fp)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            yield tuple(c[a].item() for c in cols), fp[a:z]


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """(key, all its parts), for keys of bounded size."""
    key, parts = None, []
    for k, values in _runs(batches, keys):
        if k != key and parts:
            yield key, parts
            parts = []
        key = k
        parts.append(values)
    if parts:
        yield key, parts


def links(prints: DataFrame, radius: int, block: int) -> DataFrame:
    """(a, b): forests over the distinct fingerprints ``fp`` that join all pairs within ``radius`` bits."""
    masks = covering_masks(radius)
    tables = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "bucket"),
    )
    dealt = tables.repartition("mask", "bucket").sortWithinPartitions("mask", "bucket", "fp")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of runs of up to ``block``; the rows of longer runs with their block number."""

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["a", "b", "mask", "bucket", "part"]
            )

        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        key, held, size, sent, rows = None, [], 0, 0, []

        def close() -> None:
            if 1 < size <= block and not sent:
                rows.extend((a, b, None, None, None) for a, b in forest(np.concatenate(held), radius))

        for k, values in _runs(batches, ["mask", "bucket"]):
            if k != key:
                close()
                key, held, size, sent = k, [], 0, 0
            held.append(values)
            size += len(values)
            if size > block or sent:
                for x in np.concatenate(held).tolist():
                    rows.append((x, None, k[0], k[1], sent // block))
                    sent += 1
                held, size = [], 0
            if len(rows) >= 8192:
                yield out(rows)
                rows = []
        close()
        yield out(rows)

    found = stored(
        dealt.mapInArrow(first, "a bigint, b bigint, mask int, bucket bigint, part int"), "simhash-links"
    )
    direct = found.where("b is not null").select("a", "b")
    large = found.where("b is null").select("mask", "bucket", "part", F.col("a").alias("fp"))
    parts = large.groupBy("mask", "bucket").agg(F.max("part").alias("last"))
    cells = (
        large.join(parts, ["mask", "bucket"])
        .select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
        .select("mask", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp")
    )
    keys = ["mask", "bucket", "i", "j"]

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _grouped(batches, keys):
            pairs = forest(np.concatenate(held), radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)], ["a", "b"]
            )

    crossed = cells.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(second, "a bigint, b bigint")
    return direct.union(crossed).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): each node of (a, b) edges that is not its component's smallest, with that smallest node."""

    def mark(df: DataFrame) -> tuple:
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name
    )
    seen = mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        # a step leaves at most two rows for each of the last: few rows go to few files, whatever the partitions
        now = stored(small.coalesce(max(LEAST_FILES, 2 * seen[0] // FILE_ROWS)), name)
        last, seen = seen, mark(now)
        if last == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, block: int = 4096) -> DataFrame:
    """(doc_id, _key, fp, component_id, lead): the component's first document is ``component_id`` with key ``lead``."""
    prints = stored(fingerprints(docs, shingle), "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_key"))).alias("first")
    distinct = prints.groupBy("fp").agg(first)
    roots = components(links(distinct.select("fp"), radius, block), "simhash-components")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("first"))
    of = rooted.select("fp", "root").join(named, "root")
    return prints.join(of, "fp").select(
        "doc_id", "_key", "fp", F.col("first.doc_id").alias("component_id"), F.col("first._key").alias("lead")
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """The input's own columns, one row for each component: its first by (doc_id, key of the row)."""
    leads = (
        near_duplicates(docs.select("doc_id", "text"), **parameters)
        .where("_key = lead and doc_id <=> component_id")
        .select("_key", "doc_id")
        .distinct()
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("_row_key")
    )
    one = (
        join_documents(rows, leads, "left_semi", "_row_key", "row.doc_id")
        .withColumn("_id", F.col("row.doc_id"))
        .dropDuplicates(["_row_key", "_id"])
    )
    return one.select(*[F.col("row")[c].alias(c) for c in docs.columns])
