"""Quality classifier: nearest-neighbour voting on latent-semantic vectors.

Terms of a text: hashed words, hashed word shapes (letters by case, digits,
other characters as they are, runs shortened) and hashed steps of a few
statistics (length, repetition of words and lines). Term counts are damped,
weighted by how rare the term is in the labelled sample, and projected on
``dims`` latent dimensions: the leading singular vectors of the sample.

Fitting takes a bounded sample: at most ``max_labelled`` labelled rows of the
training side, in order of a hash of their id. What the driver holds is
``max_labelled`` rows of ``BUCKETS`` hashed terms at most; the model it
broadcasts has a fixed size. Scoring covers all documents: for each block of
documents the cosine with every labelled vector is computed exactly, block by
block, and the ``neighbours`` closest vote with their similarity as weight.

Defined results: NULL text counts as empty and is scored by its statistics;
labels without id or quality are not used; every input row gives one row,
repeated rows the same score; extra columns are ignored; an empty table gives
an empty result; without any labelled row every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts

BUCKETS = 4096
BLOCK_ROWS = 256
LABELLED_BLOCK = 1024
_SHAPE = str.maketrans(
    {x: "a" if x.islower() else "A" if x.isupper() else "0" for x in map(chr, range(0x250)) if x.isalnum()}
)
_REPEAT = re.compile(r"(.)\1+")


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % BUCKETS


def _word_buckets(word: str) -> tuple[int, int]:
    return _bucket("w " + word.lower()), _bucket("s " + _REPEAT.sub(r"\1", word.translate(_SHAPE)))


def terms(text: str, memo: dict[str, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of a text and their damped counts."""
    counts: Counter = Counter()
    distinct: Counter = Counter()
    n, again, last = 0, 0, None
    for part in parts(text):  # long texts are taken in pieces
        words = part.split()
        distinct.update(words)
        again += sum(a == b for a, b in zip([last, *words], words, strict=False))
        n, last = n + len(words), words[-1] if words else last
    for word, k in distinct.items():
        pair = memo.get(word)
        if pair is None:
            if len(memo) >= 200_000:
                memo.clear()
            pair = memo[word] = _word_buckets(word)
        counts[pair[0]] += k
        counts[pair[1]] += k
    lines = [x for x in text.split("\n") if x.strip()]
    steps = {
        "length": n.bit_length(),
        "distinct": round(10 * len(distinct) / max(n, 1)),
        "again": round(10 * again / max(n, 1)),
        "lines": round(10 * len(set(lines)) / max(len(lines), 1)),
    }
    at = np.fromiter(counts.keys(), np.int64, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    # the statistics weigh as much as a frequent term
    strong = np.float32(max(1.0, float(value.max()) if n else 1.0))
    extra = np.array([_bucket(f"{k} {v}") for k, v in steps.items()], np.int64)
    return np.concatenate([at, extra]), np.concatenate([value, np.full(len(extra), strong, np.float32)])


def _dense(texts: list[str], memo: dict) -> np.ndarray:
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in enumerate(texts):
        at, value = terms(text, memo)
        np.add.at(out[row], at, value)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), np.float32(1e-12))


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 4096, dims: int = 64) -> dict:
    """Model of plain arrays: term weights, projection, unit vectors and labels of the sample."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_labelled)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for b in batches:
            found = [terms(t.as_py() or "", memo) for t in b.column("text")]
            at = pa.array([f[0] for f in found], pa.list_(pa.int64()))
            value = pa.array([f[1] for f in found], pa.list_(pa.float32()))
            columns = [b.column("doc_id"), b.column("label"), at, value]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "at", "value"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most max_labelled rows
        .mapInArrow(run, f"doc_id {kind}, label int, at array<bigint>, value array<float>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(max_labelled)
        .collect()
    )
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        np.add.at(x[i], np.asarray(r.at), np.asarray(r.value, np.float32))
    rarity = np.log((1 + len(rows)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
    x = _unit(x * rarity)
    rng = np.random.default_rng(0)
    basis = rng.standard_normal((BUCKETS, dims), np.float32)
    for _ in range(5 if len(rows) else 0):  # subspace iteration towards the leading singular vectors
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    return {
        "weights": rarity,
        "projection": basis.astype(np.float32),
        "vectors": _unit(x @ basis).astype(np.float32),
        "labels": np.array([r.label for r in rows], np.float32),
    }


def vote(vectors: np.ndarray, model: dict, neighbours: int) -> np.ndarray:
    """Similarity-weighted share of label 1 among the closest labelled vectors of each row."""
    labelled, labels = model["vectors"], model["labels"]
    if not len(labels):
        return np.full(len(vectors), 0.5)
    best = np.full((len(vectors), 0), 0, np.float32)
    who = np.full((len(vectors), 0), 0, np.int64)
    for at in range(0, len(labelled), LABELLED_BLOCK):
        cosine = vectors @ labelled[at : at + LABELLED_BLOCK].T
        best = np.concatenate([best, cosine], axis=1)
        who = np.concatenate([who, np.broadcast_to(np.arange(at, at + cosine.shape[1]), cosine.shape)], axis=1)
        if best.shape[1] > neighbours:
            top = np.argpartition(-best, neighbours - 1, axis=1)[:, :neighbours]
            best, who = np.take_along_axis(best, top, 1), np.take_along_axis(who, top, 1)
    weight = np.maximum(best, 0).astype(np.float64) ** 2 + 1e-9
    return np.clip((weight * labels[who]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)


def score(docs: DataFrame, model: dict, neighbours: int = 15, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                x = _dense([t.as_py() or "" for t in part.column("text")], memo)
                vectors = _unit((x * m["weights"]) @ m["projection"])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(vote(vectors, m, neighbours))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
