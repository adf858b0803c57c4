"""Packing of training examples into sequences by vector bin packing.

An example has a demand vector: its tokens, one segment, its loss-bearing
tokens. A sequence has a limit on each. Dot-product heuristic: the next example
of the open sequence is, among those that fit, the one whose demand has the
largest dot product with what the sequence has left, each dimension relative to
its limit and weighted by its share of the demand of the examples at hand. When
none fits, the sequence is filled with the head of the longest example (where
``cut`` allows it) and closed.

Examples beyond a limit are split into pieces within it. Without ``cut``, as
for instruction data, any other example stays whole. With ``cut``, pieces of
fewer than ``least_piece`` tokens are not made while examples are left to come;
the last sequences of a task are powers of two, filled exactly unless another
limit forbids it.

Scale. Each task packs the examples it holds, a pool of ``pool`` at a time, so
nothing is shuffled and memory does not grow with the input; the price is at
most the last sequences of a task. The sequences are written to the shared
folder: whoever reads them sees one packing, even after lost executors. A
sequence's number is the task's partition and a count.

Defined results: NULL text is an empty document (only the end id); rows are
packed one by one, so repeated rows and NULL ids are packed like any other;
extra columns are ignored; an example without tokens has no piece; an empty
table gives no piece; very long texts are encoded and cut piece by piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import byte_bpe, encoder, word_parts

BATCH_BYTES = 1 << 22


@dataclass(frozen=True)
class Limits:
    """Of one sequence; a piece of an example is one segment."""

    tokens: int = 2048
    segments: int = 64
    loss_tokens: int = 2048


@dataclass
class Piece:
    """A slice of an example: ``n`` ids from ``start``; ``loss`` counts its loss-bearing ids up to each place."""

    row: tuple  # the columns carried along, and the example's number of ids
    ids: np.ndarray
    loss: np.ndarray | None
    start: int
    n: int

    def loss_of(self, n: int) -> int:
        return n if self.loss is None else int(self.loss[self.start + n] - self.loss[self.start])

    def fitting(self, tokens: int, loss: int) -> int:
        """Length of the longest head within both limits."""
        n = min(self.n, tokens)
        if self.loss_of(n) <= loss:
            return n
        if self.loss is None:
            return min(n, loss)
        return int(np.searchsorted(self.loss[self.start : self.start + n + 1], self.loss[self.start] + loss, "right")) - 1

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.ids, self.loss, self.start, n), Piece(self.row, self.ids, self.loss, self.start + n, self.n - n)


def pieces_within(examples: Iterator[Piece], limits: Limits) -> Iterator[Piece]:
    """The examples, those beyond a limit split into pieces within it."""
    for piece in examples:
        while piece.n:
            n = max(1, piece.fitting(limits.tokens, limits.loss_tokens))
            head, piece = piece.split(n)
            yield head


def sequences(examples: Iterator[Piece], limits: Limits, cut: bool, least_piece: int, pool: int) -> Iterator[list[Piece]]:
    """Packs the examples: the pieces of each sequence, in order."""
    incoming = pieces_within(examples, limits)
    caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.float64)
    demand = np.zeros((pool + 1, 3))  # one place more for the rest of an example that is cut
    held: list[Piece | None] = [None] * (pool + 1)
    free = deque(range(pool + 1))
    ended = False

    def put(piece: Piece) -> None:
        at = free.popleft()
        held[at] = piece
        demand[at] = piece.n, 1, piece.loss_of(piece.n)

    def take(at: int) -> Piece:
        piece, held[at] = held[at], None
        demand[at] = 0
        free.append(at)
        return piece

    while True:
        while not ended and len(free) > 1:
            piece = next(incoming, None)
            if piece is None:
                ended = True
            else:
                put(piece)
        total = demand.sum(axis=0)
        if not total[1]:
            return
        left = caps.copy()
        exact = cut and ended and total[0] < caps[0]
        if exact:
            left[0] = 1 << (int(total[0]).bit_length() - 1)
        weight = total / total.sum() / caps**2
        chosen: list[Piece] = []
        while left[0] and left[1]:
            fits = (demand[:, 1] > 0) & (demand <= left).all(axis=1)
            if fits.any():
                score = np.where(fits, demand @ (weight * left), -1.0)
                piece = take(int(score.argmax()))
            else:
                room = int(left[0])
                if not cut or (room < least_piece and not exact):
                    break
                longest = int(demand[:, 0].argmax())
                n = held[longest].fitting(room, int(left[2])) if held[longest] else 0
                if n < (1 if exact else least_piece):
                    break
                piece, rest = take(longest).split(n)
                put(rest)
            chosen.append(piece)
            left -= (piece.n, 1, piece.loss_of(piece.n))
        yield chosen


def document_examples(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(doc_id, ids, loss) of every row: its text's ids and the end id, all of them loss-bearing (loss is NULL)."""
    shared = docs.sparkSession.sparkContext.broadcast(byte_bpe(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(*shared.value)
        end = np.array([end_id], "<u4")

        def ids_of(text: str) -> bytes:
            found = [coder.encode_to_numpy(part, allowed_special="all") for part in word_parts(text)]
            return np.concatenate([*found, end]).astype("<u4").tobytes()

        for batch in batches:
            at, size, out = 0, 0, []
            for i, text in enumerate(batch.column("_text"), 1):
                out.append(ids_of(text.as_py() or ""))
                size += len(out[-1])
                if size > BATCH_BYTES or i == batch.num_rows:
                    ids = pa.array(out, pa.binary())
                    loss = pa.nulls(len(out), pa.binary())
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(out)), ids, loss], names)
                    at, size, out = i, 0, []

    names = ["doc_id", "ids", "loss"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(run, f"doc_id {kind}, ids binary, loss binary")


def conversation_examples(conversations: DataFrame, tokenizer: str, end_id: int = 1, answers: str = "assistant") -> DataFrame:
    """(conv_id, ids, loss) of every conversation: its turns in order, each closed by the end id.

    Loss-bearing are the ids of turns whose role is ``answers``: 1 in ``loss``,
    a byte per id. A turn's ids do not depend on other turns; turns without a
    number come last, those of rows without conv_id make one conversation.
    """
    turns = document_examples(
        conversations.select(F.struct("conv_id", "turn", "role").alias("doc_id"), F.col("text").alias("text")), tokenizer, end_id
    )
    n = F.octet_length("ids") / 4
    mask = F.unhex(F.repeat(F.when(F.col("doc_id.role") == answers, "01").otherwise("00"), n.cast("int")))
    order = F.struct(F.col("doc_id.turn").isNull().alias("last"), "doc_id.turn", "ids", mask.alias("loss"))
    whole = turns.groupBy("doc_id.conv_id").agg(F.sort_array(F.collect_list(order)).alias("t"))
    return whole.select("conv_id", *[F.aggregate(F.col(f"t.{c}"), F.lit(b""), lambda a, x: F.concat(a, x)).alias(c) for c in ("ids", "loss")])


def pack(
    examples: DataFrame, limits: Limits | None = None, cut: bool = True, least_piece: int = 16, pool: int = 1024
) -> DataFrame:
    """The pieces of all examples (a key, ids, loss): the key, start, length, ids, tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit integers, ``loss`` a byte per id (NULL: all bear loss);
    ``tokens`` is the example's number of ids, ``offset`` the piece's place in its sequence.
    """
    key = next(c for c in examples.columns if c not in ("ids", "loss"))
    limits = limits or Limits()
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("limits below 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        kinds: list[pa.DataType] = []

        def examples_of() -> Iterator[Piece]:
            for b in batches:
                kinds[:] = [b.column(key).type]
                for name, ids, loss in zip(b.column(key), b.column("ids"), b.column("loss"), strict=True):
                    numbers = np.frombuffer(ids.as_py() or b"", "<u4")
                    mask = loss.as_py()
                    if mask is not None:
                        mask = np.concatenate([[0], np.cumsum(np.frombuffer(mask, np.uint8))])
                    yield Piece((name.as_py(), len(numbers)), numbers, mask, 0, len(numbers))

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            types = [kinds[0], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        rows, size = [], 0
        for number, pieces in enumerate(sequences(examples_of(), limits, cut, least_piece, pool)):
            at = 0
            for p in pieces:
                data = p.ids[p.start : p.start + p.n].tobytes()
                rows.append((p.row[0], p.start, p.n, data, p.row[1], first | number, at))
                at += p.n
                size += len(data) + 64
            if size > BATCH_BYTES:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    names = [key, "start", "length", "ids", "tokens", "sequence_id", "offset"]
    kind = examples.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, start bigint, length bigint, ids binary, tokens bigint, sequence_id bigint, offset bigint"
    return stored(examples.select(key, "ids", "loss").mapInArrow(run, schema), "packed-sequences")
