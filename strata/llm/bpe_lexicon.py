"""Byte-level BPE with a transducer lexicon: encoding and decoding of whole texts.

Pre-tokens. The texts of a batch lie end to end in its buffer. The characters'
kinds (letter, number, blank, other) give the places where the pattern cuts, for
all texts at once; the pre-tokens are slices of that buffer, and only distinct
ones become strings. Very long texts and texts with a special token's string
are walked with the pattern itself.

Lexicon. Pre-tokens are counted over all documents (per batch in the tasks,
then by a partial aggregate); the ``lexicon_words`` most frequent ones are
compiled, with their token ids, into a minimal acyclic transducer: words share
prefixes and suffixes, and the outputs along a path add up to the word's rank,
which addresses its ids. The automaton is a flat byte string; each worker maps
it from an unlinked file of its own and walks it in place, many words abreast.

Encoding. A text is split at the special tokens' strings, the parts by the
pre-tokenizer's pattern; a word in the lexicon gives its ids, any other word is
merged exactly: lowest rank first, leftmost first, again many words abreast.
Words of the lexicon are remembered for the task, others for a batch of texts.
The texts' ids are taken from those of the distinct words, by their numbers.
A batch is cut into parts of a bounded number of bytes: words and ids are listed
for a part at a time, so the lists do not grow with the batch or the texts'
lengths. A worker gets what its own side needs, encoding the merges as
arrays, decoding the tokens' bytes. Decoding takes the ids' bytes from that
table for a part at a time.

The lexicon only speeds the encoding up: results are those of the vocabulary
file alone. Its size is fixed by the parameter, so the broadcast is bounded.

Defined results: NULL text counts as empty (no ids, empty text back); rows are
independent, so repeated rows and NULL ids are encoded like any other; extra
columns of any name are left out of the result but for those named in
``carry``; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import batched, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_arrow_batches, stored

# The pattern that splits text before the merges, and its classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KINDS = (r"\p{L}+", r"\p{N}+", r"\s+")  # kinds 1 to 3; any other character is of kind 0
BLANK = 3
BATCH_BYTES = 1 << 20  # texts, or id lists, that are worked on together
PLACE = 6  # bits of a place in a word
LONG_WORD = 1 << PLACE  # bytes; longer words are merged one by one
LONG_TEXT = 1 << 20  # longer texts and id lists are walked, not listed whole
COUNTED_WORDS = 300_000  # words that a task counts before it passes them on; it holds about twice as many


def byte_letters() -> dict[str, int]:
    """The printable stand-in letter of each byte value in byte-level vocabularies, inverted."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _by_length(words: list[bytes]) -> dict[int, list[int]]:
    """Positions of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    return {len(words[at[0]]): at.tolist() for at in np.split(order, cuts) if len(at)}


def _letters(words: list[bytes], at: list[int], size: int) -> np.ndarray:
    """The words at some positions, all of one length, as rows of byte values."""
    return np.frombuffer(b"".join([words[i] for i in at]), np.uint8).reshape(-1, size)


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.token_bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if all(c in letters for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        by_byte = {letters[t]: i for t, i in vocab.items() if len(t) == 1 and t in letters}
        self.first = [by_byte[b] for b in range(256)]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merged = np.asarray([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.keys = np.asarray(sorted(ranks), np.int64)  # of the pairs
        self.key_ranks = np.asarray([ranks[k] for k in self.keys.tolist()], np.int64)

    def merges(self) -> dict:
        """The parts that ``merge`` needs, as broadcast: without the tokens' bytes."""
        return {k: getattr(self, k) for k in ("special", "first", "merged", "keys", "key_ranks")}

    @classmethod
    def of(cls, parts: dict) -> Vocabulary:
        """From the ``merges`` of another one."""
        out = object.__new__(cls)
        out.__dict__.update(parts)
        return out

    @cached_property
    def ranks(self) -> dict[int, int]:
        """Rank by pair key; only long words need it."""
        return dict(zip(self.keys.tolist(), self.key_ranks.tolist(), strict=True))

    @cached_property
    def byte_ranks(self) -> np.ndarray:
        """Rank of each pair of bytes, with which every word starts."""
        first = np.asarray(self.first, np.int64)
        return self._rank_of(first[:, None], first[None, :])

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; beyond the last one for pairs that do not merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], len(self.merged))

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (as bytes) of pre-tokens by exact merging: lowest rank first, leftmost first."""
        out: list[bytes] = [b""] * len(words)
        for size, at in _by_length(words).items():
            if size > LONG_WORD:
                for i in at:
                    out[i] = np.asarray(self._merge_heap(words[i]), "<u4").tobytes()
            elif size:
                for i, ids in zip(at, self._merge_abreast(_letters(words, at, size)), strict=True):
                    out[i] = ids
        return out

    def _merge_abreast(self, letters: np.ndarray) -> list[bytes]:
        """For words of one length, a row each: every round merges the best pair of each row."""
        n, size = letters.shape
        none = len(self.merged) << PLACE
        letters, at = letters.T, np.arange(size)[:, None]
        ids = np.asarray(self.first, np.int64)[letters]  # a column each from here on; -1 where a token was merged away
        after, before = np.repeat(at + 1, n, axis=1), np.repeat(at - 1, n, axis=1)
        pairs = np.full((size, n), none)  # a pair's rank, then its place, so that the least one is the next to merge
        pairs[:-1] = self.byte_ranks[letters[:-1], letters[1:]] << PLACE | at[:-1]
        while True:
            least = pairs.min(axis=0)
            rows = np.flatnonzero(least < none)
            if not len(rows):
                break
            i = least[rows] & LONG_WORD - 1
            ids[i, rows] = new = self.merged[least[rows] >> PLACE]
            j = after[i, rows]
            ids[j, rows] = -1
            pairs[i, rows] = pairs[j, rows] = none
            after[i, rows] = k = after[j, rows]
            on = k < size
            i_on, k_on, own = i[on], k[on], rows[on]
            before[k_on, own] = i_on
            pairs[i_on, own] = self._rank_of(new[on], ids[k_on, own]) << PLACE | i_on
            h = before[i, rows]
            on = h >= 0
            h_on, own = h[on], rows[on]
            pairs[h_on, own] = self._rank_of(ids[h_on, own], new[on]) << PLACE | h_on
        ids = ids.T
        data = ids[ids >= 0].astype("<u4").tobytes()
        return [data[x:y] for x, y in pairwise([0, *(4 * np.cumsum((ids >= 0).sum(axis=1))).tolist()])]

    def _merge_heap(self, word: bytes) -> list[int]:
        """For a long word, in O(n log n)."""
        rank_of = self.ranks.get
        ids = [self.first[b] for b in word]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(pairwise(ids)) if (r := rank_of(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one side was merged meanwhile
            new = int(self.merged[rank])
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank_of(new << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, new, ids[k]))
            if (h := before[i]) >= 0 and (r := rank_of(ids[h] << 32 | new)) is not None:
                heapq.heappush(heap, (r, h, ids[h], new))
        return [i for i in ids if i >= 0]


def compile_lexicon(entries: dict[bytes, bytes]) -> bytes:
    """Minimal acyclic transducer of ``entries`` (word to ids, as bytes) as one byte string."""
    states: dict[tuple, int] = {}
    arcs: list[tuple] = []  # per state: ((label, target), ...)
    final: list[bool] = []
    count: list[int] = []

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in states:
            states[key] = len(arcs)
            arcs.append(key[1])
            final.append(node[0])
            count.append(node[0] + sum(count[t] for _, t in key[1]))
        return states[key]

    words = sorted(entries)
    path: list[list] = [[False, []]]
    last = b""
    for w in words:
        shared = 0
        while shared < min(len(w), len(last)) and w[shared] == last[shared]:
            shared += 1
        while len(path) > shared + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))
        path += [[False, []] for _ in w[shared:]]
        path[-1][0] = True
        last = w
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(node)))
    root = settle(path[0])

    keys, targets, outputs = [], [], []  # an arc's key: its state and label, so keys are sorted
    for state, own in enumerate(arcs):
        rank = int(final[state])
        for label, target in own:
            keys.append(state << 8 | label)
            targets.append(target)
            outputs.append(rank)
            rank += count[target]
    ids = [entries[w] for w in words]
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
    numbers = [[root, len(arcs), len(keys), len(words)], keys, targets, outputs, ends]
    return b"".join([*(np.asarray(x, "<u4").tobytes() for x in numbers), *ids, bytes(final)])


class Lexicon:
    """Reads a compiled lexicon in place from any buffer."""

    def __init__(self, buffer):
        view = memoryview(buffer)
        self.root, n_states, n_arcs, n_words = np.frombuffer(view, "<u4", 4).tolist()
        at = 16

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += 4 * n
            return np.frombuffer(view, "<u4", n, at - 4 * n)

        self.keys, self.target, self.output = take(n_arcs), take(n_arcs), take(n_arcs)
        self.ends = take(n_words + 1)
        self.ids = take(int(self.ends[-1]))
        self.final = np.frombuffer(view, np.uint8, n_states, at)

    def get(self, words: list[bytes]) -> list[bytes | None]:
        """Ids (as bytes) of each word, None for a word that is not in the lexicon."""
        out: list[bytes | None] = [None] * len(words)
        for size, at in _by_length(words).items():
            state, rank = np.full(len(at), self.root, np.uint32), np.zeros(len(at), np.int64)
            known = np.full(len(at), len(self.keys) > 0 or size == 0)
            letters = _letters(words, at, size) if size and known.any() else ()
            for j in range(size if known.any() else 0):
                key = state << np.uint32(8) | letters[:, j]
                k = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known &= self.keys[k] == key
                if not known.any():
                    break
                rank += self.output[k]
                state = self.target[k]
            found = np.flatnonzero(known & (self.final[state] > 0)).tolist()
            for i in found:
                out[at[i]] = self.ids[self.ends[rank[i]] : self.ends[rank[i] + 1]].tobytes()
        return out


def _mapped(data: bytes) -> mmap.mmap:
    with tempfile.TemporaryFile() as f:  # unlinked: nothing stays behind
        f.write(data)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def _by_bytes(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``BATCH_BYTES`` of a column's values, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - sizes[at]
        stop = max(at + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _splitter(special: dict[str, int]):
    import regex

    words = regex.compile(PATTERN)
    marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def split(text: str) -> Iterable[str]:
        if len(text) > LONG_TEXT:
            return walk(text)
        if marks is None or not any(m in text for m in special):
            return words.findall(text)
        return list(walk(text))

    def walk(text: str) -> Iterator[str]:
        at = 0
        for mark in marks.finditer(text) if marks else ():
            yield from (m.group() for m in words.finditer(text[at : mark.start()]))
            yield mark.group()
            at = mark.end()
        yield from (m.group() for m in words.finditer(text[at:]))

    return split


def kind_runs() -> tuple[np.ndarray, np.ndarray]:
    """Kinds of all code points by the pattern's classes, as runs: their kinds and lengths."""
    import regex

    every = "".join(map(chr, range(0x110000)))
    kinds = np.zeros(len(every), np.uint8)
    for kind, chars in enumerate(KINDS, 1):
        for m in regex.finditer(chars, every):
            kinds[m.start() : m.end()] = kind
    at = np.flatnonzero(np.diff(kinds, prepend=255))
    return kinds[at], np.diff(at, append=len(kinds))


def _offsets(values: pa.Array) -> np.ndarray:
    """Places in the data buffer at which the strings of an array start, and the end of the last one."""
    if not len(values):
        return np.zeros(1, np.int32)
    return np.frombuffer(values.buffers()[1], "<i4", len(values) + 1, 4 * values.offset)


def _data(values: pa.Array) -> np.ndarray:
    """The bytes of an array's strings, end to end."""
    ends, data = _offsets(values), values.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)


def _strings(kind: pa.DataType, offsets: np.ndarray, data) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


def _values(column: pa.Array) -> list:
    """As ``to_pylist`` of a column without NULLs, in a fraction of its time."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Cutter:
    """Cuts many texts at once into the pre-tokens that ``PATTERN`` finds in each."""

    def __init__(self, runs: tuple[np.ndarray, np.ndarray]):
        self.kinds = np.repeat(*runs)
        self.of_bytes = self.kinds[:256].tobytes()  # for ASCII only

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pre-tokens of texts without NULLs, in order, and how many there are up to the end of each text."""
        data, ends = _data(texts), _offsets(texts)
        ends = ends[1:] - ends[0]
        if not len(data):
            return pa.array([], pa.string()), np.zeros(len(ends), np.int64)
        if data.max() < 128:
            at = self._starts(data, np.frombuffer(data.tobytes().translate(self.of_bytes), np.uint8), ends)
        else:
            points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
            lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
            at = lead[self._starts(points, self.kinds[points], np.searchsorted(lead, ends))]
        return _strings(pa.string(), np.append(at, len(data)), data), np.searchsorted(at, ends)

    @staticmethod
    def _starts(points: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places where pre-tokens start, of code points with their kinds; ``ends`` are those of the texts."""
        n = len(points)
        first = np.zeros(n + 1, bool)  # of a text
        first[0] = first[ends] = True
        blank = kinds == BLANK
        starts = np.empty(n, bool)
        starts[1:] = kinds[1:] != kinds[:-1]
        # the last one of a run of blanks stands alone, or with what follows if it is a space
        starts[:-1] |= blank[:-1] & ~blank[1:] & ~first[1:n]
        starts[1:] &= blank[1:] | (points[:-1] != 32)
        starts |= first[:n]
        quotes = np.flatnonzero(starts & (points == 39))
        if len(quotes):  # 's 't 'm 'd 're 've 'll
            stop = ends[np.searchsorted(ends, quotes, "right")]
            one, two = (np.where(quotes + k < stop, points[np.minimum(quotes + k, n - 1)], 0) for k in (1, 2))
            short = np.isin(one, list(b"stmd"))
            long = np.isin(one, list(b"rv")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            size = np.where(short, 2, np.where(long, 3, 0))
            quotes, stop, size = quotes[size > 0], stop[size > 0], size[size > 0]
            starts[quotes + 1] = False
            after = quotes + size
            starts[after[after < stop]] = True
        return np.flatnonzero(starts)


def _set_apart(texts: pa.Array, special: dict[str, int]) -> tuple[pa.Array, dict[int, str]]:
    """The texts for the cutter, and by place those that are walked instead (there left empty)."""
    texts = pc.fill_null(texts, "")
    walked = pc.greater(pc.binary_length(texts), LONG_TEXT)
    for mark in special:
        walked = pc.or_(walked, pc.match_substring(texts, mark))
    at = np.flatnonzero(walked.to_numpy(zero_copy_only=False)).tolist()
    if at:
        own = {i: texts[i].as_py() for i in at}
        return pc.if_else(walked, pa.scalar("", texts.type), texts).cast(pa.string()), own
    return texts.cast(pa.string()), {}


def word_counts(docs: DataFrame, special: dict[str, int], text: str = "text") -> DataFrame:
    """(word, n): pre-tokens of all documents."""
    runs = kind_runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cutter = _splitter(special), Cutter(runs)
        held: list[pa.Table] = []  # counts of parts, or their sums

        def hold(words: pa.Array, numbers: pa.Array) -> None:
            held.append(pa.table({"word": words, "n": numbers}))

        def sums() -> pa.Table:
            found = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return found.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for b in batches:
            for part in _by_bytes(b, b.schema.names[0]):
                texts, walked = _set_apart(part.column(0), special)
                hold(*cutter.words(texts)[0].value_counts().flatten())
                for t in walked.values():
                    counts = Counter(split(t))
                    hold(pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64()))
                if sum(x.num_rows for x in held) >= 2 * COUNTED_WORDS:
                    held[:] = [sums()]
                    if held[0].num_rows >= COUNTED_WORDS:
                        yield from held.pop().to_batches()
        if held:
            yield from sums().to_batches()

    return docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, lexicon_words: int) -> bytes:
    """Compiled lexicon of the corpus's most frequent words, at most ``lexicon_words`` of 64 letters or fewer.

    The least count that qualifies comes from the histogram of counts (few
    rows, whatever the number of words); the words beyond it are collected.
    """
    counts = stored(word_counts(docs, vocabulary.special).where(F.char_length("word") <= 64), "bpe-words")
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    more = F.sum("words").over(Window.orderBy(F.desc("n")))
    fits = histogram.withColumn("more", more).where(F.col("more") <= lexicon_words).agg(F.min("n")).first()[0]
    top = counts.where(F.col("n") >= fits).select("word").collect() if fits is not None else []
    words = [w.encode() for w in sorted({r.word for r in top} - set(vocabulary.special))]
    return compile_lexicon(dict(zip(words, vocabulary.merge(words), strict=True)))


def encode(docs: DataFrame, tokenizer: str, lexicon_words: int = 100_000, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, n_tokens and ids (little-endian unsigned 32-bit integers, binary) of every row."""
    bound_arrow_batches(docs.sparkSession)
    vocabulary = Vocabulary(tokenizer)
    lexicon = build_lexicon(docs, vocabulary, lexicon_words)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.merges(), lexicon, kind_runs()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, data, runs = shared.value
        vocab = Vocabulary.of(parts)
        lexicon = Lexicon(_mapped(data))
        split, cutter = _splitter(vocab.special), Cutter(runs)
        frequent = {t: np.asarray([i], "<u4").tobytes() for t, i in vocab.special.items()}

        def ids_of(words: list[str]) -> list[bytes]:
            """Ids of distinct words; those of the lexicon stay known."""
            ids = list(map(frequent.get, words))
            new = [i for i, x in enumerate(ids) if x is None]
            raw = [words[i].encode() for i in new]
            rare = []
            for i, w, x in zip(new, raw, lexicon.get(raw), strict=True):
                if x is None:
                    rare.append((i, w))
                else:
                    ids[i] = frequent[words[i]] = x
            for (i, _), x in zip(rare, vocab.merge([w for _, w in rare]), strict=True):
                ids[i] = x
            return ids

        def ids_of_text(text: str) -> bytes:
            out = []
            for words in batched(split(text), LONG_TEXT):
                names = list(dict.fromkeys(words))
                ids = dict(zip(names, ids_of(names), strict=True))
                out.append(b"".join([ids[w] for w in words]))
            return b"".join(out)

        def ids_of_texts(texts: pa.Array) -> pa.Array:
            words, last = cutter.words(texts)
            numbered = words.dictionary_encode()
            ids = pa.array(ids_of(_values(numbered.dictionary)), pa.binary()).take(numbered.indices)
            return _strings(pa.binary(), _offsets(ids)[np.append(0, last)], _data(ids))

        for b in batches:
            for part in _by_bytes(b, "_text"):
                texts, walked = _set_apart(part.column("_text"), vocab.special)
                out = ids_of_texts(texts)
                if walked:
                    out = pa.array([ids_of_text(walked[i]) if i in walked else x for i, x in enumerate(_values(out))], pa.binary())
                n = pa.array(np.diff(_offsets(out)) // 4, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carry), n, out], [*carry, "n_tokens", "ids"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(*carry, F.col("text").alias("_text")).mapInArrow(run, f"{fields}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of ``encoded`` plus ``decoded``, the text of its ``ids``."""
    bound_arrow_batches(encoded.sparkSession)
    table = Vocabulary(tokenizer).token_bytes
    shared = encoded.sparkSession.sparkContext.broadcast([table.get(i, b"") for i in range(max(table) + 1)])
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = pa.array(shared.value, pa.binary())

        def bytes_of(ids: np.ndarray) -> pa.Array:
            return letters.take(pa.array(ids))

        def text_of(ids: bytes) -> str:
            numbers = np.frombuffer(ids, "<u4")
            pieces = (numbers[at : at + LONG_TEXT] for at in range(0, len(numbers), LONG_TEXT))
            return b"".join([_data(bytes_of(piece)).tobytes() for piece in pieces]).decode("utf-8", "replace")

        def texts_of(ids: pa.Array) -> pa.Array:
            ends = _offsets(ids)
            if ends[-1] - ends[0] <= 4 * LONG_TEXT:
                found = bytes_of(_data(ids).view("<u4"))
                texts = _strings(pa.string(), _offsets(found)[(ends - ends[0]) // 4], _data(found))
                try:
                    texts.validate(full=True)
                    return texts
                except pa.ArrowInvalid:  # some ids' bytes are no UTF-8: text by text
                    pass
            return pa.array([text_of(x.as_py()) for x in ids], pa.string())

        for b in batches:
            for part in _by_bytes(b, "ids"):
                texts = texts_of(pc.fill_null(part.column("ids"), b"").cast(pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded string")
