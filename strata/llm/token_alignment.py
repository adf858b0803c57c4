"""Alignment of two tokenizers' tokens on the bytes of a text.

Tokenizer A (byte-level BPE) encodes a blank and the text, B (pieces with byte
fallback) the text, before which it puts a blank of its own: the bytes of both
token sequences are the same, or the text is left without tokens. Incidence
matrices in CSR form, built by hand: A has a row per A token with a one at each
of its bytes, Bᵀ a row per byte with a one at the B token there. Bytes between
two ends of tokens have equal columns and rows and are kept as one, with their
number. Gustavson's row products give A·Bᵀ, whose entries are the bytes that two
tokens share: the overlap links. Those whose tokens end together cut the tokens into groups; the
product of the group incidence matrices, again by rows, gives the shared-group
links.

Counts over the corpus. Of two tokens that end together one's bytes end the
other's: the vocabularies alone bound the pairs that can be linked
(``linkable``, some hundred thousand). Links are stored as numbers of such
pairs, counted per task and summed by Spark; the table of counts, one number
per pair, is what goes back to the tasks.

Scale. Texts are encoded one by one, very long ones piece by piece: a piece
ends where tokens of both sides end, so groups and links of the pieces are
those of the whole text, and several pieces can be aligned side by side. Nothing is shuffled but the pairs' counts.

Defined results: NULL or empty texts, and texts whose tokens do not give back
their bytes (such as those with U+2581), have no tokens and no links; rows are
aligned one by one, so repeated rows and NULL ids count like any other (also in
the corpus-wide counts); extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import byte_bpe, encoder, word_parts

BATCH_BYTES = 1 << 22
TOGETHER = 1 << 15  # A tokens
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: row i has ``columns[ends[i]:ends[i + 1]]`` with their values."""

    ends: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.ends) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.ends))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(ends, self.rows()[order], self.values[order], self.height)


def runs(lengths: np.ndarray) -> Csr:
    """Incidence of rows with so many columns each, one after the other: tokens and their bytes, groups and their tokens."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    n = int(ends[-1])
    return Csr(ends, np.arange(n), np.ones(n, np.int64), n)


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each row of a·b has before equal columns are added: Gustavson's symbolic phase."""
    sizes = np.concatenate([[0], np.cumsum(np.diff(b.ends)[a.columns])])
    return sizes[a.ends[1:]] - sizes[a.ends[:-1]]


def multiply(a: Csr, b: Csr) -> Csr:
    """a·b by Gustavson's row products: row i is the sum of b's rows at the columns of a's row i."""
    taken = np.diff(b.ends)[a.columns]  # entries of b that each entry of a brings in
    first = np.repeat(b.ends[a.columns] - np.concatenate([[0], np.cumsum(taken)[:-1]]), taken)
    at = first + np.arange(len(first))
    key = np.repeat(a.rows(), taken) * b.width + b.columns[at]
    value = np.repeat(a.values, taken) * b.values[at]
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    key, value = key[new], np.add.reduceat(value, new) if len(new) else value
    ends = np.searchsorted(key, np.arange(a.height + 1) * b.width)
    return Csr(ends, key % max(b.width, 1), value, b.width)


@dataclass(frozen=True)
class Alignment:
    """Of the tokens of one text, or of one piece of it."""

    a: np.ndarray  # ids
    b: np.ndarray
    overlaps: Csr  # A·Bᵀ: bytes that an A and a B token share
    groups_a: Csr  # groups by A tokens
    groups_b: Csr

    def end_links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and B tokens that end together: the last of each group."""
        return self.groups_a.ends[1:] - 1, self.groups_b.ends[1:] - 1

    def group_links(self) -> Csr:
        """A tokens by B tokens of the same group."""
        return multiply(self.groups_a.transposed(), self.groups_b)


def align(a: np.ndarray, b: np.ndarray, bytes_a: np.ndarray, bytes_b: np.ndarray) -> Alignment:
    """Aligns ids whose tokens have so many bytes each, the same in all on both sides."""
    ends_a, ends_b = np.cumsum(bytes_a), np.cumsum(bytes_b)
    stretches = Stretches(ends_a, ends_b)
    overlaps = multiply(stretches.of(ends_a, stretches.sizes), stretches.of(ends_b).transposed())
    row, column = overlaps.rows(), overlaps.columns
    together = ends_a[row] == ends_b[column]
    last_a, last_b = row[together], column[together]
    sizes_a, sizes_b = (np.diff(np.concatenate([[-1], x])) for x in (last_a, last_b))
    return Alignment(a, b, overlaps, runs(sizes_a), runs(sizes_b))


class Stretches:
    """Bytes between two ends of tokens of either side: columns (of A) and rows (of Bᵀ) that are alike, as one."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        self.ends = ends[np.diff(ends, prepend=0) > 0]
        self.sizes = np.diff(self.ends, prepend=0)

    def of(self, ends: np.ndarray, values: np.ndarray | None = None) -> Csr:
        """Incidence of the tokens with such ends and their stretches."""
        n = len(self.ends)
        upto = np.concatenate([[0], np.searchsorted(self.ends, ends, "right")])
        return Csr(upto, np.arange(n), np.ones(n, np.int64) if values is None else values, n)


class PairNumbers:
    """The numbers of known pairs: most by one look into a hashed table, the others by bisection."""

    BITS, FACTOR = 21, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, known: np.ndarray):
        self.known, self.table = known, np.zeros(1 << self.BITS, np.int32)
        self.table[self._place(known)] = np.arange(len(known))

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.view(np.uint64) * self.FACTOR) >> np.uint64(64 - self.BITS)

    def of(self, pairs: np.ndarray) -> np.ndarray:
        at = self.table[self._place(pairs)]
        other = np.flatnonzero(self.known[at] != pairs)
        at[other] = np.searchsorted(self.known, pairs[other])
        return at


class Tokenizers:
    """Both tokenizers with the bytes of their tokens; to be built in the task."""

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int], model: bytes):
        import sentencepiece

        self.coder = encoder(ranks, {})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_b = piece_bytes(self.pieces)
        sizes = {i: len(t) for t, i in ranks.items()}
        self.len_a = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)])
        self.len_b = np.array([len(t) for t in self.bytes_b])

    def encoded(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """The ids of each piece of the text; None for a piece whose tokens do not give back its bytes."""
        for part in word_parts(text):
            # the pieces after the first start with the blank that B would add
            whole, bare = (" " + part, part) if not part.startswith(" ") or part is text else (part, part[1:])
            raw = whole.encode()
            a = self.coder.encode_to_numpy(whole, allowed_special=set(), disallowed_special=())
            b = self.pieces.encode(bare)
            if b"".join([self.bytes_b[i] for i in b]) != raw or self.coder.decode_bytes(a.tolist()) != raw:
                yield None
            else:
                yield a, np.asarray(b, np.int64)

    def joined(self, ids: list[tuple[np.ndarray, np.ndarray]]) -> Alignment:
        """The alignment of pieces side by side: both sides' tokens end where a piece ends."""
        a, b = (np.concatenate(x) for x in zip(*ids, strict=True))
        return align(a, b, self.len_a[a], self.len_b[b])

    def align(self, text: str) -> Iterator[Alignment | None]:
        """The alignment of each piece of the text; None for a piece whose tokens do not give back its bytes."""
        for ids in self.encoded(text):
            yield None if ids is None else self.joined([ids])


def piece_bytes(pieces) -> list[bytes]:
    """The bytes of each piece of a sentencepiece model."""
    out = []
    for i in range(pieces.get_piece_size()):
        name = pieces.id_to_piece(i)
        byte = BYTE_PIECE.fullmatch(name)
        out.append(bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode())
    return out


def linkable(ranks: dict[bytes, int], pieces: list[bytes]) -> np.ndarray:
    """All pairs of an A and a B token that can end together, as sorted numbers a << 32 | b."""
    by_bytes: dict[bytes, list[int]] = {}
    for i, t in enumerate(pieces):
        if t:
            by_bytes.setdefault(t, []).append(i)
    pairs = {a << 32 | b for t, a in ranks.items() for k in range(len(t)) for b in by_bytes.get(t[k:], ())}
    pairs |= {ranks[t[k:]] << 32 | b for t, own in by_bytes.items() for k in range(len(t)) if t[k:] in ranks for b in own}
    return np.array(sorted(pairs), np.int64)


class GroupText:
    """Writes ids by groups: A ids, a bar, B ids; groups parted by semicolons."""

    def __init__(self, size_a: int, size_b: int):
        self.words = np.array(
            [f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for mark in marks for i in range(size)], object
        )
        self.size_a, self.size_b = size_a, size_b

    def words_of(self, x: Alignment) -> list[str]:
        """One for each id, with the mark after it: a piece's stand together."""
        last_a, last_b = x.end_links()
        closes_a, closes_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        closes_a[last_a] = closes_b[last_b] = 1
        out = np.empty(len(x.a) + len(x.b), np.int64)
        # a group's A tokens stand behind the B tokens of the groups before it, its B tokens behind its own A tokens
        out[np.arange(len(x.a)) + np.repeat(x.groups_b.ends[:-1], np.diff(x.groups_a.ends))] = x.a + closes_a * self.size_a
        out[np.arange(len(x.b)) + np.repeat(x.groups_a.ends[1:], np.diff(x.groups_b.ends))] = (
            2 * self.size_a + x.b + closes_b * self.size_b
        )
        return self.words[out].tolist()

    def write(self, x: Alignment) -> str:
        return "".join(self.words_of(x))


def _broadcast(docs: DataFrame, byte_file: str, piece_file: str):
    import sentencepiece

    ranks, special = byte_bpe(byte_file)
    with open(piece_file, "rb") as f:
        model = f.read()
    pairs = linkable(ranks, piece_bytes(sentencepiece.SentencePieceProcessor(model_proto=model)))
    return docs.sparkSession.sparkContext.broadcast((ranks, special, model, pairs)), pairs


def _in_batches(batches: Iterator[pa.RecordBatch], rows_of, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (a tuple and its size in bytes) that ``rows_of`` makes of each batch, in batches of bounded size."""
    rows, size = [], 0
    for b in batches:
        for row, weight in rows_of(b):
            rows.append(row)
            size += weight
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def links(docs: DataFrame, byte_file: str, piece_file: str, kind: str = "overlap") -> DataFrame:
    """One row per link: doc_id, piece of the text, places and ids of both tokens there, n_bytes shared.

    ``kind``: "overlap" (tokens that share bytes), "end" (that end together)
    or "group" (of one group; n_bytes is 0 where they share none).
    """
    shared, _ = _broadcast(docs, byte_file, piece_file)
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    block = 1 << 16  # A tokens whose links are made at a time

    def of(x: Alignment) -> Iterator[tuple]:
        groups = x.groups_a.transposed()
        for at in range(0, len(x.a), block):
            end = min(at + block, len(x.a))

            def part(m: Csr, at: int = at, end: int = end) -> Csr:
                lo, hi = m.ends[at], m.ends[end]
                return Csr(m.ends[at : end + 1] - lo, m.columns[lo:hi], m.values[lo:hi], m.width)

            overlap = part(x.overlaps)
            if kind == "group":
                found = multiply(part(groups), x.groups_b)
                have = overlap.rows() * found.width + overlap.columns
                key = found.rows() * found.width + found.columns
                k = np.minimum(np.searchsorted(have, key), len(have) - 1)
                values = np.where(have[k] == key, overlap.values[k], 0)
                row, column = found.rows(), found.columns
            else:
                row, column, values = overlap.rows(), overlap.columns, overlap.values
                if kind == "end":
                    last_a, last_b = x.end_links()
                    partner = np.full(len(x.a), -1)
                    partner[last_a] = last_b
                    here = partner[row + at] == column
                    row, column, values = row[here], column[here], values[here]
            row = row + at
            yield from zip(row.tolist(), column.tolist(), x.a[row].tolist(), x.b[column].tolist(), values.tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, special, model, _ = shared.value
        both = Tokenizers(ranks, special, model)

        def rows_of(b: pa.RecordBatch):
            for doc_id, text in zip(b.column("doc_id"), b.column("_text"), strict=True):
                value, key = text.as_py() or "", doc_id.as_py()
                if any(x is None for x in both.align(value)):
                    continue
                for piece, x in enumerate(both.align(value)):
                    for link in of(x):
                        yield (key, piece, *link), 64

        for b in batches:
            schema = pa.schema([("doc_id", b.column("doc_id").type), *[(c, pa.int64()) for c in names]])
            yield from _in_batches(iter([b]), rows_of, schema)

    names = ["piece", "place_a", "place_b", "id_a", "id_b", "n_bytes"]
    if kind not in ("overlap", "end", "group"):
        raise ValueError(f"no links of kind {kind!r}")
    fields = ", ".join(f"{c} bigint" for c in names)
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(run, f"doc_id {id_kind}, {fields}")


class Measures:
    """What is known of a text after some of its pieces."""

    def __init__(self, doc_id):
        self.doc_id, self.counts, self.links = doc_id, np.zeros(6, np.int64), []
        self.digest, self.mark, self.failed = hashlib.sha256(), "", False

    def add(self, counts: list[int], groups: str, numbers: np.ndarray) -> None:
        self.counts += counts
        self.digest.update((self.mark + groups[:-1]).encode())
        self.mark = ";"
        self.links.append(numbers.tobytes())

    def row(self) -> tuple:
        if self.failed or not self.counts[0]:
            return (self.doc_id, *[0] * 6, "", b"")
        return (self.doc_id, *self.counts.tolist(), self.digest.hexdigest(), b"".join(self.links))


def _measures(texts: Iterator[tuple], both: Tokenizers, writer: GroupText, numbers: PairNumbers) -> Iterator[Measures]:
    """Of each (doc_id, text) in order: pieces are aligned side by side, about ``TOGETHER`` A tokens at a time."""
    held: list[tuple[Measures, np.ndarray, np.ndarray]] = []

    def add_held() -> None:
        x = both.joined([ids for _, *ids in held])
        last_a, last_b = x.end_links()
        found = numbers.of(x.a[last_a].astype(np.int64) << 32 | x.b[last_b]).astype("<u4")
        group_links = np.concatenate([[0], np.cumsum(product_sizes(x.groups_a.transposed(), x.groups_b))])
        words = writer.words_of(x)
        end_a, end_b = (np.cumsum([0, *map(len, side)]) for side in zip(*[ids for _, *ids in held], strict=True))
        end_g, end_o, end_l = np.searchsorted(last_a, end_a), x.overlaps.ends[end_a], group_links[end_a]
        sizes = np.diff([end_a, end_b, end_g, end_g, end_o, end_l]).T.tolist()
        at, to = ((end_a + end_b).tolist(), end_g.tolist())
        for k, (one, *_) in enumerate(held):
            one.add(sizes[k], "".join(words[at[k] : at[k + 1]]), found[to[k] : to[k + 1]])
        held.clear()

    waiting, size = [], 0
    for doc_id, text in texts:
        waiting.append(Measures(doc_id))
        for ids in both.encoded(text):
            if ids is None:
                waiting[-1].failed = True
                break
            held.append((waiting[-1], *ids))
            size += len(ids[0])
            if size >= TOGETHER:
                add_held()
                yield from waiting[:-1]
                waiting, size = waiting[-1:], 0
    if held:
        add_held()
    yield from waiting


def aligned(docs: DataFrame, byte_file: str, piece_file: str) -> tuple[DataFrame, np.ndarray]:
    """Stored rows of every document, and the pairs that can be linked.

    doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_group_links, groups_sha256, links: the pair's number
    of each link (little-endian unsigned 32-bit integers).
    """
    shared, pairs = _broadcast(docs, byte_file, piece_file)
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, special, model, known = shared.value
        both = Tokenizers(ranks, special, model)
        writer, numbers = GroupText(len(both.len_a), len(both.len_b)), PairNumbers(known)

        def rows_of(b: pa.RecordBatch):
            texts = ((i.as_py(), t.as_py() or "") for i, t in zip(b.column("doc_id"), b.column("_text"), strict=True))
            for x in _measures(texts, both, writer, numbers):
                row = x.row()
                yield row, len(row[-1]) + 200

        for b in batches:
            schema = pa.schema([("doc_id", b.column("doc_id").type), *zip(names, types, strict=True)])
            yield from _in_batches(iter([b]), rows_of, schema)

    names = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_group_links", "groups_sha256", "links"]
    types = [*[pa.int64()] * 6, pa.string(), pa.binary()]
    fields = ", ".join(f"{c} bigint" for c in names[:6])
    out = docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(
        run, f"doc_id {id_kind}, {fields}, groups_sha256 string, links binary"
    )
    return stored(out, "token-alignment"), pairs


def pair_counts(rows: DataFrame, n_pairs: int) -> np.ndarray:
    """How many links hold each linkable pair, over all rows; at most one number per pair reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_pairs, np.int64)
        for b in batches:
            found = b"".join([x.as_py() for x in b.column("links")])
            counts += np.bincount(np.frombuffer(found, "<u4"), minlength=n_pairs)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["pair", "n"])

    summed = rows.select("links").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    out = np.zeros(n_pairs, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out


def measure(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Per row: the counts of its alignment, n_best, count_sum, groups_sha256."""
    rows, pairs = aligned(docs, byte_file, piece_file)
    counts = pair_counts(rows, len(pairs))
    b = pairs & 0xFFFFFFFF
    top = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(top, b, counts)
    shared = docs.sparkSession.sparkContext.broadcast((counts, counts == top[b]))
    names = [c for c in rows.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, best = shared.value
        for batch in batches:
            found = [np.frombuffer(x.as_py(), "<u4") for x in batch.column("links")]
            n_best = pa.array([int(best[f].sum()) for f in found], pa.int64())
            total = pa.array([int(number[f].sum()) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], n_best, total], [*names, "n_best", "count_sum"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "links")
    return rows.mapInArrow(run, f"{kinds}, n_best bigint, count_sum bigint")
