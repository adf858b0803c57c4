"""Packing and token alignment against the tokenizer libraries and brute force, and on edge cases."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import queries as Q
from strata.llm import token_alignment, tokens, vector_packing
from strata.llm.common import table
from strata.llm.vector_packing import Limits
from tests.conftest import SMOKE_SF

from .conftest import EDGE_ROWS

ODD = ["a<|endoftext|>b <|endoftext|>", "x" * 5000, "I'll  we've\n\n  \t'S 12345 ٣٤ 日本語 🙂🙂", "\x00\x01   ", "a ▁ b", " lead", "<s> <0x41>"]


@pytest.fixture(scope="module")
def odd(spark, edge):
    return edge.unionByName(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(ODD)], edge.schema))


def test_long_texts_in_parts():
    text = "Some words here. " * 20 + "  tail\nend of it"
    for size in (1, 5, 30):
        parts = list(tokens.word_parts(text, size))
        assert "".join(parts) == text and len(parts) > 5
        assert all(p[0] == " " and p[1].isalpha() for p in parts[1:])


# ------------------------------------------------------------ packing


def ids_by_hand(text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(Q.tokenizer_file()).encode(text or "", add_special_tokens=False).ids, 1]


def check_packing(pieces, expected, limits):
    """Every id lies in one piece, sequences are gapless and within their limits."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) <= limits.tokens and len(own) <= limits.segments
    whole = Counter()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for doc_id, own in by_doc.items():
        wanted = expected[doc_id]
        copies = sum(n for _, n, _, _ in own) / len(wanted[0])
        assert copies == len(wanted)
        covered = Counter(i for start, n, _, _ in own for i in range(start, start + n))
        assert set(covered) == set(range(len(wanted[0]))) and set(covered.values()) == {len(wanted)}
        for start, n, crc, total in own:
            assert total == len(wanted[0])
            assert crc == zlib.crc32(np.asarray(wanted[0][start : start + n], "<u4").tobytes())
        whole[doc_id] += len(wanted)
    assert set(by_doc) == set(expected)
    return [sum(p.length for p in own) for own in by_sequence.values()]


def padding(sizes, capacity):
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in sizes) / sum(sizes)


def test_packing(spark):
    docs = table(spark, SMOKE_SF, "documents").collect()
    expected = {r.doc_id: [ids_by_hand(r.text)] for r in docs}
    sizes = check_packing(Q.op11_packing(spark, SMOKE_SF).collect(), expected, Limits())
    assert padding(sizes, 2048) < 0.01


def packed(examples, limits, **more):
    out = vector_packing.pack(examples, limits, **more)
    return out.select("*", F.crc32("ids").alias("ids_crc32"), F.col("tokens").alias("doc_tokens")).collect()


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 3, 64), Limits(1, 1, 1)])
def test_packing_edges(spark, odd, clashing, empty, limits):
    few = odd.where("doc_id is null or doc_id <> 6") if limits.tokens < 2048 else odd
    groups = defaultdict(list)
    for r in few.collect():
        groups[r.doc_id, r.text].append(ids_by_hand(r.text))
    # rows that share an id but not their text are told apart by their length only: give each text an id
    names = {k: i for i, k in enumerate(groups)}
    known = spark.createDataFrame([(i, k[1], k[0]) for k, i in names.items() for _ in groups[k]], "doc_id long, text string, old long")
    got = packed(vector_packing.document_examples(known, Q.tokenizer_file()), limits)
    sizes = check_packing(got, {names[k]: v for k, v in groups.items()}, limits)
    assert limits.segments < 64 or padding(sizes, limits.tokens) < 0.01
    if limits.tokens == 2048:
        assert packed(vector_packing.document_examples(empty, Q.tokenizer_file()), limits) == []
        rows = packed(vector_packing.document_examples(clashing, Q.tokenizer_file()), limits)
        assert sum(r.start == 0 for r in rows) == len(EDGE_ROWS)


def test_packing_under_three_limits(spark):
    """Instruction data: whole examples, answers bear loss, no limit is broken."""
    talks = table(spark, SMOKE_SF, "conversations")
    examples = vector_packing.conversation_examples(talks, Q.tokenizer_file())
    turns = defaultdict(list)
    for r in talks.collect():
        turns[r.conv_id].append((r.turn, r.role, ids_by_hand(r.text)))
    rows = {r.conv_id: r for r in examples.collect()}
    assert set(rows) == set(turns)
    loss = {}
    for conv_id, own in turns.items():
        own.sort(key=lambda t: (t[0] is None, t[0], np.asarray(t[2], "<u4").tobytes()))
        assert np.frombuffer(rows[conv_id].ids, "<u4").tolist() == [i for t in own for i in t[2]]
        mask = [int(t[1] == "assistant") for t in own for _ in t[2]]
        assert list(rows[conv_id].loss) == mask
        loss[conv_id] = mask
    limits = Limits(4096, 5, 1500)
    got = vector_packing.pack(examples, limits, cut=False).collect()
    used = defaultdict(lambda: [0, 0, 0])
    for p in got:
        u = used[p.sequence_id]
        u[0] += p.length
        u[1] += 1
        u[2] += sum(loss[p.conv_id][p.start : p.start + p.length])
    assert all(u[0] <= 4096 and u[1] <= 5 and u[2] <= 1500 for u in used.values())
    split = {p.conv_id for p in got if p.length < p.tokens}
    assert all(len(loss[c]) > 4096 or sum(loss[c]) > 1500 for c in split)
    assert sum(p.length for p in got) == sum(map(len, loss.values()))


def test_next_example_has_the_largest_dot_product():
    def piece(name, n, loss):
        mask = np.concatenate([[0], np.cumsum([1] * loss + [0] * (n - loss))])
        return vector_packing.Piece((name, n), np.zeros(n, np.uint32), mask, 0, n)

    demands = {"a": (60, 10), "b": (50, 45), "c": (40, 5), "d": (30, 30), "e": (10, 0)}
    out = vector_packing.sequences(iter(piece(k, *v) for k, v in demands.items()), Limits(100, 4, 50), False, 1, 8)
    got = [[p.row[0] for p in own] for own in out]
    # by hand: weights are the dimensions' shares of the demand at hand, each relative to its limit
    total = np.array([190, 5, 90], float)
    caps = np.array([100, 4, 50], float)
    weight = total / total.sum() / caps**2
    score = {k: (np.array([n, 1, x]) * weight * caps).sum() for k, (n, x) in demands.items()}
    assert got[0][0] == max(score, key=score.get)
    assert sorted(x for own in got for x in own) == sorted(demands)
    for own in got:
        assert sum(demands[k][0] for k in own) <= 100 and sum(demands[k][1] for k in own) <= 50


# ------------------------------------------------------------ alignment


def alignment_by_hand(texts):
    """Per text: A ids, B ids, groups and links, all by ends in a dictionary."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_coder = Tokenizer.from_file(Q.tokenizer_file())
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_file("piece_bpe_32k.model"))
    names = {i: t for t, i in a_coder.get_vocab().items()}
    from strata.llm.bpe_lexicon import byte_letters

    letters = byte_letters()
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in names[i]) for i in a]
        bytes_b = []
        for i in b:
            p = b_coder.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:5], 16)]) if b_coder.is_byte(i) else p.replace("▁", " ").encode())
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append(([], [], [], [], 0))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups = [
            ([i for i, e in zip(a, ends_a, strict=True) if lo < e <= hi], [i for i, e in zip(b, ends_b, strict=True) if lo < e <= hi])
            for lo, hi in zip([0, *cuts], cuts, strict=False)
        ] if len(whole) < 4000 else None
        at_b = dict(zip(ends_b, b, strict=True))
        links = [(i, at_b[e]) for i, e in zip(a, ends_a, strict=True) if e in at_b]
        spans_a, spans_b = ([(e - len(x), e) for e, x in zip(ends, xs, strict=True)] for ends, xs in ((ends_a, bytes_a), (ends_b, bytes_b)))
        overlaps = sum(min(p[1], q[1]) > max(p[0], q[0]) for p in spans_a for q in spans_b) if len(a) < 300 else None
        out.append((a, b, groups, links, overlaps))
    return out


def expected_rows(ids, texts):
    found = alignment_by_hand(texts)
    counts = Counter(x for _, _, _, links, _ in found for x in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    for doc_id, (a, b, groups, links, overlaps) in zip(ids, found, strict=True):
        text = None if groups is None else ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        yield (
            (-1 if doc_id is None else doc_id, len(a), len(b), None if groups is None else len(groups), len(links)),
            (sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links)),
            None if text is None else hashlib.sha256(text.encode()).hexdigest() if a else "",
            overlaps,
            None if groups is None else sum(len(x) * len(y) for x, y in groups),
        )


def same(got, wanted):
    """Equal but for values that were not worked out by hand."""
    return all(w is None or (same(g, w) if isinstance(w, tuple) else g == w) for g, w in zip(got, wanted, strict=True))


def rows_of(out):
    return [
        ((-1 if r.doc_id is None else r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links), (r.n_best, r.count_sum), r.groups_sha256, r.n_overlaps, r.n_group_links)
        for r in out.collect()
    ]


def test_alignment(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMOKE_SF, "documents").collect()}
    got = {r[0][0]: r for r in rows_of(Q.op12_token_alignment(spark, SMOKE_SF))}
    wanted = list(expected_rows(docs, docs.values()))
    assert len(got) == len(wanted) and all(same(got[w[0][0]], w) for w in wanted)


def files():
    return Q.tokenizer_file(), Q.tokenizer_file("piece_bpe_32k.model")


def test_alignment_edges(spark, odd, empty, clashing):
    docs = odd.where("doc_id is null or doc_id <> 6").collect()
    got = rows_of(token_alignment.measure(spark.createDataFrame(docs, odd.schema), *files()))
    wanted = list(expected_rows([r.doc_id for r in docs], [r.text for r in docs]))
    assert len(got) == len(wanted)
    for w in wanted:
        hit = next(i for i, g in enumerate(got) if same(g, w))
        got.pop(hit)
    assert token_alignment.measure(empty, *files()).count() == 0
    assert token_alignment.measure(clashing, *files()).count() == len(EDGE_ROWS)


def test_alignment_work_follows_tokens(monkeypatch):
    """The product runs over stretches between token ends, not bytes, and over several texts at once; rows are as one by one."""
    ranks, special = tokens.byte_bpe(files()[0])
    both = token_alignment.Tokenizers(ranks, special, open(files()[1], "rb").read())
    sizes, multiply = [], token_alignment.multiply
    monkeypatch.setattr(token_alignment, "multiply", lambda a, b: sizes.append(len(a.columns)) or multiply(a, b))
    text = "Considerable responsibilities, internationally " * 40
    x = next(both.align(text))
    assert sum(sizes) <= len(x.a) + len(x.b) < len(text.encode())
    known = token_alignment.linkable(ranks, both.bytes_b)
    numbers = token_alignment.PairNumbers(known)
    assert (numbers.of(known) == np.arange(len(known))).all()  # also those whose place in the table is another's
    writer = token_alignment.GroupText(len(both.len_a), len(both.len_b))
    texts = [text, "", "a b", "x \u2581 y", "\u65e5\u672c é", " ", text[:100], "a\u2581", "end"]

    def measured(at_once):
        monkeypatch.setattr(token_alignment, "TOGETHER", at_once)
        sizes.clear()
        return [m.row() for m in token_alignment._measures(enumerate(texts), both, writer, numbers)], len(sizes)

    alone, n_alone = measured(1)
    assert [r[0] for r in alone] == list(range(len(texts))) and n_alone == 6
    assert measured(1 << 20) == (alone, 1) and measured(60) == (alone, 2)


def test_alignment_in_parts(monkeypatch):
    ranks, special = tokens.byte_bpe(files()[0])
    both = token_alignment.Tokenizers(ranks, special, open(files()[1], "rb").read())
    writer = token_alignment.GroupText(len(both.len_a), len(both.len_b))
    text = "The quick, bröwn fox  jumps over\n\n it 1234 times " * 12 + "again"
    whole = [writer.write(x) for x in both.align(text)]
    monkeypatch.setattr(token_alignment, "word_parts", lambda t: tokens.word_parts(t, 40))
    parts = [writer.write(x) for x in both.align(text)]
    assert len(whole) == 1 and len(parts) > 5 and "".join(parts) == whole[0]


def test_row_products_against_dense():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, y = rng.integers(0, 3, (rng.integers(1, 9), 7)), rng.integers(0, 3, (7, rng.integers(1, 9)))

        def csr(m):
            row, column = np.nonzero(m)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(m)))])
            return token_alignment.Csr(ends, column, m[row, column], m.shape[1])

        def dense(m):
            out = np.zeros((m.height, m.width), int)
            out[m.rows(), m.columns] = m.values
            return out

        assert (dense(token_alignment.multiply(csr(x), csr(y))) == x @ y).all()
        assert (dense(csr(x).transposed()) == x.T).all()
        assert token_alignment.product_sizes(csr(x), csr(y)).sum() == ((x > 0).astype(int) @ (y > 0)).sum()


def test_links(spark):
    texts = ["Überraschung, isn't it?", "", "unbelievable 12345"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = alignment_by_hand(texts)
    got = {k: token_alignment.links(docs, *files(), kind=k).collect() for k in ("overlap", "end", "group")}
    for i, (a, b, groups, links, overlaps) in enumerate(found):
        own = {k: [r for r in rows if r.doc_id == i] for k, rows in got.items()}
        assert sorted((r.id_a, r.id_b) for r in own["end"]) == sorted(links)
        assert len(own["overlap"]) == overlaps
        assert sum(r.n_bytes for r in own["overlap"]) == (len((" " + texts[i]).encode()) if a else 0)
        assert sorted((r.id_a, r.id_b) for r in own["group"]) == sorted((x, y) for p, q in groups for x in p for y in q)
        assert {(r.place_a, r.place_b) for r in own["overlap"]} <= {(r.place_a, r.place_b) for r in own["group"]}
