"""Operators on documents against brute force, and on edge cases."""

from __future__ import annotations

import hashlib
import re
import time
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import (
    bpe_lexicon,
    license_join,
    line_templates,
    phrase_index,
    quality_knn,
    quality_rules,
    simhash_covering,
    substring_dedup,
)
from strata.llm import queries as Q
from strata.llm.common import ARROW_BOUND, ARROW_BYTES, table
from tests.conftest import SMOKE_SF

from .conftest import EDGE_ROWS, LONG, PROSE

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def alnum(text):
    return ALNUM_WORD.findall(lower(text))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SMOKE_SF, "documents").collect()}


# ------------------------------------------------------------ quality rules


def rules_by_hand(text):
    words = BLANK_WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if BLANK_WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_quality_rules(spark, texts, edge):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in Q.op8_quality_rules(spark, SMOKE_SF).collect():
        assert tuple(r[n] for n in names) == rules_by_hand(texts[r.doc_id]), r.doc_id
        assert not (r.kept and r.base_failed)
    got = quality_rules.judge(edge).select(F.col("row.text").alias("text"), *names, "kept").collect()
    assert len(got) == len(EDGE_ROWS)
    for r in got:
        assert tuple(r[n] for n in names) == rules_by_hand(r.text)
        assert r.kept == (r.text in (PROSE, LONG))


def test_quality_rules_edges(edge, empty, clashing):
    assert quality_rules.judge(empty).count() == quality_rules.filter_documents(empty).count() == 0
    kept = quality_rules.filter_documents(clashing)
    assert kept.columns == clashing.columns
    wanted = Counter(tuple(r) for r in clashing.collect() if r.text in (PROSE, LONG))
    assert Counter(tuple(r) for r in kept.collect()) == wanted
    plain = quality_rules.filter_documents(edge).collect()
    assert Counter(plain) == Counter(r for r in edge.collect() if r.text in (PROSE, LONG))


def test_quality_rules_follow_labels(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.op8_quality_rules(spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    assert sum(r.kept for r in rows if r.quality == 0) <= 2
    assert sum(not r.kept and not r.base_failed for r in rows if r.quality == 1) <= 2


# ------------------------------------------------------------ line templates


def lines_by_hand(docs, depth=3, similarity=0.75, min_tokens=1):
    """docs: (doc_id, text); the (doc_id, line number) pairs that go: lines are connected through alike ones."""
    leaves = defaultdict(lambda: defaultdict(list))
    for doc_id, text in docs:
        for no, line in enumerate((text or "").split("\n")):
            words = tuple(BLANK_WORD.findall(re.sub(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>", line)))
            if words == ("<*>",):
                words = tuple(BLANK_WORD.findall(line))
            if len(words) >= max(1, min_tokens):
                leaves[len(words), words[:depth]][words].append((doc_id, no))
    gone = set()
    for forms in leaves.values():
        left = set(forms)
        while left:
            group = [left.pop()]
            for form in group:
                near = {g for g in left if sum(map(str.__eq__, form, g)) >= similarity * len(form)}
                left -= near
                group += near
            places = [p for form in group for p in forms[form]]
            if len({d for d, _ in places}) > 1:
                gone |= set(places) - {min(places)}
    return gone


def test_line_dedup(spark, texts):
    gone = lines_by_hand(texts.items())
    got = Q.op4_line_dedup(spark, SMOKE_SF).collect()
    assert {(r.doc_id, int(no)) for r in got for no in r.dropped.split(",") if no} == gone and gone
    for r in got:
        kept = [x for no, x in enumerate(texts[r.doc_id].split("\n")) if (r.doc_id, no) not in gone]
        assert r.text == "\n".join(kept)


def test_line_dedup_generalises_fields(spark):
    rows = [(i, f"user {i} logged in from host h{i} at noon today\nunlike line number x {'abc'[i]}") for i in range(3)]
    rows += [(9, "user bob logged in from host alpha at noon today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: r.dropped for r in line_templates.drop_recurring_lines(docs).collect()}
    # digits are wildcards; the leaf of doc 9 starts with other tokens, so it stays
    assert got == {0: [], 1: [0, 1], 2: [0, 1], 9: []}


def test_line_dedup_edges(edge, empty, clashing):
    got = [(r.row.doc_id, r.row.text, r.text, len(r.dropped)) for r in line_templates.drop_recurring_lines(edge).collect()]
    assert len(got) == len(EDGE_ROWS)
    for doc_id, before, after, dropped in got:
        if before == PROSE:  # the earliest document keeps its lines; rows without an id come last
            assert (after == PROSE) == (doc_id == 1) and (dropped > 0) == (doc_id != 1)
        else:
            assert after == before and not dropped
    assert line_templates.dedup_documents(empty).count() == 0
    out = line_templates.dedup_documents(clashing)
    assert out.columns == clashing.columns and out.count() == len(EDGE_ROWS)
    assert out.where("doc_id = 2").select("n_chars").distinct().collect()[0][0] == 0


# ------------------------------------------------------------ simhash


def fingerprint_by_hand(text, k=4):
    words = BLANK_WORD.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints, radius=4):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark, texts):
    prints = {i: fingerprint_by_hand(t) for i, t in texts.items()}
    groups = components_by_hand(prints)
    for r in Q.op2_simhash_near_dedup(spark, SMOKE_SF).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", groups[r.doc_id])


def test_long_texts_in_pieces(monkeypatch):
    """Whatever the size of the pieces, words, shingles and counts are those of the whole text."""
    from strata.llm import common

    text = "Ab  c\n" * 50 + "one two \t three four" + " x" * 30
    whole = [simhash_covering.fingerprint(t.encode(), 4) for t in (text, "a b", "")]
    assert [w & (2**64 - 1) for w in whole] == [fingerprint_by_hand(t) for t in (text, "a b", "")]
    scored = [x.tolist() for x in quality_knn.terms(text, {})]
    for size in (1, 7, 40):
        assert "".join(common.parts(text, size)) == text
        for module in (simhash_covering, quality_knn):
            monkeypatch.setattr(module, "parts", lambda t, size=size: common.parts(t, size))
        assert [simhash_covering.fingerprint(t.encode(), 4) for t in (text, "a b", "")] == whole
        assert [x.tolist() for x in quality_knn.terms(text, {})] == scored
    split = bpe_lexicon._splitter({"<|endoftext|>": 0})
    odd = "a<|endoftext|>  b c's<|endoftext|> \n\n d"
    listed = split(odd)
    monkeypatch.setattr(bpe_lexicon, "LONG_TEXT", 3)
    assert list(split(odd)) == listed


def test_covering_masks_miss_no_pair():
    rng = np.random.default_rng(1)
    masks = simhash_covering.covering_masks(4)
    assert len(masks) == 31
    for _ in range(2000):
        bits = rng.choice(64, 4, replace=False)
        change = sum(1 << int(b) for b in bits)
        assert any(m & change == 0 for m in masks)


@pytest.mark.parametrize("block", [2, 7, 4096])
def test_simhash_links_through_blocks(spark, block):
    """Runs longer than a block are compared block by block; components are those of all pairs."""
    rng = np.random.default_rng(2)
    base = rng.integers(-(2**63), 2**63 - 1, 12)
    values = {int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (12, 2))}
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash_covering.links(df, 4, block)
    root = {r.node: r.root for r in simhash_covering.components(links).collect()}
    order = {v: n for n, v in enumerate(sorted(values))}
    by_hand = components_by_hand({order[v]: v & (2**64 - 1) for v in values})
    assert {order[v]: order[root.get(v, v)] for v in values} == by_hand


def test_components_store_few_rows_in_few_files(spark, monkeypatch):
    """The files of a step follow its rows, not the number of partitions; many rows keep their partitions."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    chain = [(n, n + 1) for n in range(0, 40) if n % 10]
    wanted = {n: (n - 1) - (n - 1) % 10 + 1 for n in range(2, 41) if n % 10 != 1}
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for rows, fewest, most in ((100_000, 1, 8), (1, 9, 40)):
            monkeypatch.setattr(simhash_covering, "FILE_ROWS", rows, raising=False)
            found = simhash_covering.components(spark.createDataFrame(chain, "a long, b long"))
            assert {r.node: r.root for r in found.collect()} == wanted
            assert fewest <= len(found.inputFiles()) <= most
    finally:
        spark.conf.set(key, was)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_simhash_edges(edge, empty, clashing):
    got = Counter((r.doc_id, r.component_id) for r in simhash_covering.near_duplicates(edge).collect())
    # texts without words share fingerprint zero; the group's id is its smallest id
    assert got == Counter(
        {(1, 1): 1, (2, 1): 2, (None, 1): 1, (3, 3): 1, (4, 3): 1, (5, 3): 1, (None, 3): 2, (6, 6): 1, (7, 7): 1, (8, 8): 1}
    )
    assert simhash_covering.near_duplicates(empty).count() == 0
    one = simhash_covering.keep_one(clashing)
    assert one.columns == clashing.columns
    assert sorted(r.doc_id for r in one.collect()) == [1, 3, 6, 7, 8]


# ------------------------------------------------------------ phrase index


def phrases_by_hand(docs, items, window=13):
    at = defaultdict(set)
    for item_id, text in items:
        words = alnum(text)
        for i in range(max(1, len(words) - window + 1)) if words and item_id is not None else ():
            at[tuple(words[i : i + window])].add(str(item_id))
    out = []
    for doc_id, text in docs:
        words, hit, ids = alnum(text), set(), set()
        for size in {len(p) for p in at}:
            for i in range(len(words) - size + 1):
                if found := at.get(tuple(words[i : i + size])):
                    ids |= found
                    hit |= set(range(i, i + size))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return Counter(out)


def test_decontamination(spark, texts):
    items = [(r.item_id, r.text) for r in table(spark, SMOKE_SF, "benchmark").collect()]
    got = Q.op9_benchmark_decontamination(spark, SMOKE_SF).drop("n_near").collect()
    assert Counter(map(tuple, got)) == phrases_by_hand(texts.items(), items)
    assert any(r.contaminated for r in got)


@pytest.mark.parametrize("block_terms", [1, 100_000])
def test_decontamination_edges(spark, edge, empty, clashing, block_terms):
    items = [
        (1, "One, TWO three"),
        (1, "été straße"),
        (2, "one two three"),
        (3, None),
        (4, " .. "),
        (None, "One two"),
        (5, LONG[:400]),
        (5, LONG[:400]),
        (6, "the of"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = phrase_index.contaminated(edge, benchmark, block_terms=block_terms)
    rows = got.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids"), F.sha2(F.array_join("item_ids", ","), 256), "contaminated"
    )
    assert Counter(map(tuple, rows.collect())) == phrases_by_hand([r[:2] for r in EDGE_ROWS], items)
    if block_terms > 1:
        assert phrase_index.contaminated(empty, benchmark).count() == 0
        none = phrase_index.contaminated(edge, benchmark.where("false"))
        assert none.where("n_hit > 0 or contaminated").count() == 0 and none.count() == len(EDGE_ROWS)
        clean = phrase_index.keep_clean(clashing, benchmark)
        assert clean.columns == clashing.columns
        assert clean.where("doc_id in (6, 7, 8)").count() == 0 and clean.where("doc_id = 2").count() == 2


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "zebra " + "x " * 40 + "quagga"), (2, "zebra " + "x " * 60 + "quagga"), (3, "quagga and zebra")], "doc_id long, text string"
    )
    items = spark.createDataFrame([(1, "zebra quagga")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in phrase_index.find(docs, items, slop=50).collect()}
    assert got == {1: (0, 1), 2: (0, 0), 3: (0, 1)}


# ------------------------------------------------------------ byte-level BPE


def tokens_by_hand(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer_file())
    for text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        raw = np.asarray(ids, "<u4").tobytes()
        yield len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe(spark, texts):
    got = Q.op6_bpe_round_trip(spark, SMOKE_SF).collect()
    expected = dict(zip(texts, tokens_by_hand(texts.values()), strict=True))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected


@pytest.mark.parametrize("words", [0, 3, 100_000])
def test_bpe_edges(spark, edge, empty, clashing, words):
    odd = ["a<|endoftext|>b <|endoftext|>", "x" * 5000, "I'll  we've\n\n  \t'S 12345 ٣٤ 日本語 🙂🙂", "\x00\x01   ", "don't<|endoftext"]
    docs = edge.unionByName(spark.createDataFrame([(100 + i, t, None, None, None) for i, t in enumerate(odd)], edge.schema))
    path = Q.tokenizer_file()
    out = bpe_lexicon.decode(bpe_lexicon.encode(docs, path, lexicon_words=words), path)
    rows = docs.select("text").collect()
    got = Counter((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in out.collect())
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert got == Counter((i, *x) for i, x in zip(ids, tokens_by_hand(r.text for r in rows), strict=True))
    if words == 3:
        assert bpe_lexicon.encode(empty, path).count() == 0
        assert bpe_lexicon.encode(clashing, path).columns == ["doc_id", "n_tokens", "ids"]


@pytest.mark.parametrize("size", [1, 50, 4000])
def test_bpe_in_small_batches(spark, edge, monkeypatch, size):
    batch = pa.RecordBatch.from_pydict({"t": ["ab", None, "", "c" * 60, "é" * 30, "d"]})
    monkeypatch.setattr(bpe_lexicon, "BATCH_BYTES", size)
    parts = list(bpe_lexicon._by_bytes(batch, "t"))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(len((x or "").encode()) for x in p.column(0).to_pylist()) <= size for p in parts)
    assert len(parts) == {1: 5, 50: 4, 4000: 1}[size]
    assert list(bpe_lexicon._by_bytes(batch.slice(0, 0), "t")) == []


def test_bpe_worker_memory(spark, monkeypatch):
    """Lists and tables of a worker are those of a bounded part of the batch, whatever its size."""
    path, tasks = Q.tokenizer_file(), []
    text = " ".join(f"{a}{b}" for a in ("form", "take", "the", "run") for b in range(50_000))
    docs = spark.createDataFrame([(1, text[:3000])], "doc_id long, text string")
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, schema: tasks.append(f) or plain(df, f, schema))
    bpe_lexicon.decode(bpe_lexicon.encode(docs, path), path)
    _, encode, decode = tasks
    texts = [text[i : i + 3000] for i in range(0, len(text), 3000)] * 3
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "_text": texts})
    assert batch.nbytes > 5 << 20
    peaks = []
    for run in (encode, decode):
        tracemalloc.start()
        parts = list(run(iter([batch])))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    assert batch.column("decoded").to_pylist() == texts
    assert peaks[0] < 50 << 20 and peaks[1] < 10 << 20, peaks


def test_bpe_bounds_arrow_batches(spark):
    docs = spark.createDataFrame([(i, "word " * 2000) for i in range(2000)], "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes]})

    path, before = Q.tokenizer_file(), spark.conf.get(ARROW_BOUND, None)
    try:
        spark.conf.unset(ARROW_BOUND)
        bpe_lexicon.encode(docs, path)
        assert max(r.size for r in docs.mapInArrow(sizes, "size bigint").collect()) < 1.1 * ARROW_BYTES
        spark.conf.set(ARROW_BOUND, "1234567")
        bpe_lexicon.decode(bpe_lexicon.encode(docs, path), path)
        assert spark.conf.get(ARROW_BOUND) == "1234567"
    finally:
        spark.conf.unset(ARROW_BOUND) if before is None else spark.conf.set(ARROW_BOUND, before)


@pytest.mark.parametrize("ascii_only", [True, False])
def test_bpe_cuts_as_the_pattern(ascii_only):
    """Texts end to end, cut at once, give what the pattern finds in each."""
    import regex

    rng = np.random.default_rng(5)
    odd = ["", " ", "  ", "'", "x'", "'s'll've're", "I'll  we've\n'\t's 'd", "a\t b \n\n", "it's's '' 'S'l 'r've", " 12ab 3\x00"]
    if not ascii_only:
        odd += ["e\u0301 \u00a0b\u00a0\u00a0c", "\u0663\u0664x\u2028\u2028y", "\u65e5\u672c\U0001f642\U0001f642 'm\u00e9", "\u3000", "\U0001f642's"]
    letters = list("aselvrtmdZ9  \n\t''-\x1c\x00") + ([] if ascii_only else list("\x85\xa0\u3000\u00e9\u0301\u0664\u00bd\u65e5\U0001f642\u2019"))
    texts = odd + ["".join(rng.choice(letters, n)) for n in rng.integers(0, 40, 3000)]
    cutter = bpe_lexicon.Cutter(bpe_lexicon.kind_runs())
    for some in (texts, texts[::-1], odd[:1], []):
        found, last = cutter.words(pa.array(["left out", *some], pa.string()).slice(1))
        words, ends = found.to_pylist(), [0, *last.tolist()]
        found.validate(full=True)
        assert [words[a:b] for a, b in zip(ends, ends[1:])] == [regex.findall(bpe_lexicon.PATTERN, t) for t in some]


def test_bpe_counts(spark, edge, monkeypatch):
    path, mark = Q.tokenizer_file(), "<|endoftext|>"
    docs = edge.select("text").unionByName(spark.createDataFrame([("a b<|endoftext|> b",), ("b b " * 9,), (None,)], "text string"))
    split = bpe_lexicon._splitter({mark: 0})
    expected = Counter(w for r in docs.collect() for w in split(r.text or ""))
    for held in (bpe_lexicon.COUNTED_WORDS, 2):
        monkeypatch.setattr(bpe_lexicon, "COUNTED_WORDS", held)
        monkeypatch.setattr(bpe_lexicon, "BATCH_BYTES", 40)
        found = bpe_lexicon.word_counts(docs, bpe_lexicon.Vocabulary(path).special).collect()
        assert {r.word: r.n for r in found} == expected and len(found) == len(expected)


def test_bpe_decodes_cut_characters(spark):
    """Ids whose bytes are no UTF-8, alone or only next to others, beside whole texts."""
    path = Q.tokenizer_file()
    table = bpe_lexicon.Vocabulary(path).token_bytes
    one = {b: i for i, b in table.items() if len(b) == 1}
    lists = [[one[b"\xc3"]], [one[b"\xa9"]], [one[b"\xc3"], one[b"\xa9"]], [], None, [one[b"x"], one[b"\xf0"], one[b"y"]]]
    rows = [(i, None if x is None else np.asarray(x, "<u4").tobytes()) for i, x in enumerate(lists)]
    for some in (rows, rows[2:5]):
        out = bpe_lexicon.decode(spark.createDataFrame(some, "doc_id long, ids binary").coalesce(1), path).collect()
        own = {i: b"".join(table[k] for k in x or []).decode("utf-8", "replace") for i, x in enumerate(lists)}
        assert {r.doc_id: r.decoded for r in out} == {i: own[i] for i, _ in some}


def test_bpe_time(spark, monkeypatch):
    """Counting, and encoding known words, take less time than the pattern alone needs text by text."""
    import regex

    path, tasks = Q.tokenizer_file(), []
    rng = np.random.default_rng(3)
    words = np.asarray(["form", "take", "the", "run", "it's", "caf\u00e9", "12", "(so)", "\n\n"])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(1000)]
    docs = spark.createDataFrame([(1, texts[0])], "doc_id long, text string")
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, schema: tasks.append(f) or plain(df, f, schema))
    bpe_lexicon.encode(docs, path)
    batch = pa.RecordBatch.from_pydict({"text": texts, "doc_id": range(len(texts)), "_text": texts})

    def seconds(job) -> float:
        taken = []
        for _ in range(3):
            start = time.process_time()
            job()
            taken.append(time.process_time() - start)
        return min(taken)

    pattern = regex.compile(bpe_lexicon.PATTERN)
    alone = seconds(lambda: [pattern.findall(t) for t in texts])
    for run in tasks:
        assert seconds(lambda run=run: list(run(iter([batch])))) < 0.8 * alone


def test_transducer_is_minimal_and_exact():
    words = [b"tap", b"taps", b"top", b"tops", b"stop", b"stops", b"", b"\xff\x00"]
    entries = {w: np.asarray([len(w), n], "<u4").tobytes() for n, w in enumerate(words)}
    lexicon = bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon(entries))
    assert lexicon.get(words) == [entries[w] for w in words]
    assert lexicon.get([b"ta", b"tapsx", b"z", b"top"]) == [None, None, None, entries[b"top"]]
    assert bpe_lexicon.Lexicon(bpe_lexicon.compile_lexicon({})).get([b"", b"a"]) == [None, None]
    vocabulary = bpe_lexicon.Vocabulary(Q.tokenizer_file())
    texts = ["indistinguishable", "aaaaaaaaaaaa", "aaaaaaaaaaaab", "été", "x", "", "thethethe" * 9, "qzqzqzqz"]
    raw = [t.encode() for t in texts]
    by_heap = [np.asarray(vocabulary._merge_heap(r), "<u4").tobytes() for r in raw]
    assert vocabulary.merge(raw) == by_heap
    # endings share their states: a trie has 20
    assert len(lexicon.final) == 8


# ------------------------------------------------------------ licences


def licences_by_hand(text):
    words, places, labels = alnum(text), [], set()
    phrases = [(p.split(), x) for p, x in license_join.BASE_PHRASES.items()]
    for i in range(len(words)):
        for p, x in phrases:
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(x)
    more, best = set(labels), 1.0 if labels else 0.0
    longest = max(len(t.split()) for _, t in license_join.TEMPLATES)
    for paragraph in re.split("\n[\\x20\\x09\\x0B-\\x0D]*\n", text or ""):
        units = [ALNUM_WORD.findall(u.lower()) for u in re.split("\n|(?<=[.!?])[\\x20\\x09-\\x0D]+", paragraph)]
        for i, unit in enumerate(units):
            have = set(unit) | set([w for u in units[i + 1 :] for w in u][:longest]) if unit else set()
            for x, template in license_join.TEMPLATES:
                want = set(template.split())
                if len(want & have) >= 0.9 * len(want) - 1e-9:
                    more.add(x)
                    best = max(best, len(want & have) / len(want))
    return (
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(more)),
        round(best, 9),
    )


def test_license_scan(spark, edge, empty, clashing):
    texts = {r.doc_id: r.text for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = {r.doc_id: tuple(r)[1:] for r in Q.op5_license_scan(spark, "/root/testdata/sf0.01").select("doc_id", *columns).collect()}
    assert {i: (*x[:-1], round(x[-1], 9)) for i, x in got.items()} == {i: licences_by_hand(t) for i, t in texts.items()}
    odd = [
        "GNU  general-public\nlicense, Apache License; cc by cc by",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided",
        "redistribution and use. in source and binary forms",
        "ＭＩＴ License mit LICENSE Mit License",
        None,
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in license_join.scan(docs).select("doc_id", *columns).collect()}
    assert {i: (*x[:-1], round(x[-1], 9)) for i, x in got.items()} == {i: licences_by_hand(t) for i, t in enumerate(odd)}
    assert license_join.scan(edge).count() == license_join.scan(clashing).count() == len(EDGE_ROWS)
    assert license_join.scan(empty).count() == 0


# ------------------------------------------------------------ classifier


def test_classifier_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = Q.op3_quality_classifier(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in got) / len(got)
    good, bad = [r.score for r in got if r.quality], [r.score for r in got if not r.quality]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert right > 0.97 and auc > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_classifier_edges(spark, edge, empty, clashing):
    docs = table(spark, SMOKE_SF, "documents")
    labels = table(spark, SMOKE_SF, "labels")
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0)], labels.schema)
    model = quality_knn.fit(docs, labels.unionByName(odd), max_labelled=50)
    assert len(model["labels"]) <= 50
    got = quality_knn.score(clashing, model).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    assert quality_knn.score(empty, model).count() == 0
    untrained = quality_knn.fit(docs, labels.where("false"))
    assert {r.score for r in quality_knn.score(edge, untrained).collect()} == {0.5}
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(3)
    unit = quality_knn._unit
    model = {"vectors": unit(rng.standard_normal((2500, 8)).astype(np.float32)), "labels": (rng.random(2500) < 0.5).astype(np.float32)}
    x = unit(rng.standard_normal((20, 8)).astype(np.float32))
    for row, got in zip(x, quality_knn.vote(x, model, 15), strict=True):
        cosine = model["vectors"] @ row
        top = np.argsort(-cosine)[:15]
        weight = np.maximum(cosine[top], 0).astype(np.float64) ** 2 + 1e-9
        assert abs(got - (weight * model["labels"][top]).sum() / weight.sum()) < 1e-5


# ------------------------------------------------------------ substring dedup


def repeats_by_hand(docs):
    seen, spans = {}, set()
    for doc_id, text in sorted(docs):
        units, at = [], 0  # (start, stop, bytes, words, line, repeat)
        for line_no, line in enumerate((text or "").split("\n")):
            own, start = [], at
            for i, c in enumerate(line, 1):
                if i == len(line) or (c in ".!?" and line[i] in " \t\x0b\x0c\r"):
                    words = re.findall(r"\w+", line[start - at : i].lower())
                    if words:
                        key = " ".join(words)
                        own.append((start, at + i, sum(len(w.encode()) for w in words), len(words), line_no, key in seen))
                        seen.setdefault(key, (doc_id, start))
                    start = at + i
            units += own
            at += len(line) + 1
        sizes = Counter(u[4] for u in units)
        run = []
        for u in [*units, (0, 0, 0, 0, -1, False)]:
            if u[5]:
                run.append(u)
                continue
            size = sum(x[2] for x in run)
            fills = any(n == sizes[k] for k, n in Counter(x[4] for x in run).items())
            if run and (size >= 60 or (fills and size >= 30)):
                spans.add((doc_id, run[0][0], run[-1][1], sum(x[3] for x in run)))
            run = []
    return spans


def test_substring_dedup(spark, texts):
    got = Q.op1_substring_dedup(spark, SMOKE_SF).collect()
    spans = {(r.doc_id, r.start, r.stop, r.n_words) for r in got}
    assert spans == repeats_by_hand(texts.items()) and spans and len(got) == len(spans)
    assert all((r.first_doc_id, r.first_start) < (r.doc_id, r.start) for r in got)
    docs = table(spark, SMOKE_SF, "documents")
    after = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    for doc_id, text in texts.items():
        for _, start, stop, _ in sorted((s for s in spans if s[0] == doc_id), reverse=True):
            text = text[:start] + text[stop:]
        assert after[doc_id] == text


def test_substring_dedup_edges(edge, empty, clashing):
    got = substring_dedup.repeats(edge).collect()
    # the long text repeats nothing; copies of the prose go, but for the first one
    assert Counter(r.doc_id for r in got) == Counter({2: 1, None: 1})
    out = substring_dedup.remove_repeats(clashing)
    assert out.columns == clashing.columns and out.count() == len(EDGE_ROWS)
    assert {r.text for r in out.where("doc_id = 1").collect()} == {PROSE}
    assert all(len(r.text) < 5 for r in out.where("doc_id = 2").collect())
    assert substring_dedup.repeats(empty).count() == 0


def test_substring_dedup_runs(spark):
    """A short repeat goes where its neighbours or its whole line repeat, and stays where it stands alone."""
    line = "One line of boilerplate that many pages share."
    long = "This sentence has enough letters to go wherever it is found again, in any line."
    rows = [
        (1, f"{line}\nSo it is. {long} The end of it"),
        (2, f"Other words here. So it is. More of them\n重复的一段文字没有空格\n {line} "),
        (3, f"重复的一段文字没有空格\nIt ends. {long} So it is. Not so\nSo it is."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.start, r.stop, r.first_doc_id, r.first_start) for r in substring_dedup.repeats(docs).collect()}
    second, third = rows[1][1], rows[2][1]
    at, run = second.index(f" {line}"), third.index(f" {long}")
    assert got == {
        (2, at, at + 1 + len(line), 1, 0),
        (3, 0, 11, 2, second.index("重")),
        (3, run, run + len(f" {long} So it is."), 1, rows[0][1].index(f" {long}")),
    }
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert left == {1: rows[0][1], 2: second.replace(f" {line}", ""), 3: "\nIt ends. Not so\nSo it is."}


def test_substring_dedup_leaves_numbers_and_addresses_whole(spark):
    texts = [
        "Version 2.0.0 runs at 10.0.0.1 for $7.99 a month, says bob@site.org.",
        "Version 1.0.0 runs at 10.0.0.2 for $8.99 a month, says ann@site.org.",
        "See site.org and 10.0.0.1 for 7.99. The site.org of bob@site.org costs 7.99 too.",
        "e.g. this costs 7.99 \n 7.99! 10.0.0.1? site.org.",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert substring_dedup.repeats(docs).count() == 0
    assert {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()} == dict(enumerate(texts))
    edge = ["end.\r\nend.", "a. ! b?! c... d", "...", "x." * 40, ". . .", "a.\x0bb.\tc", "\n\n.\n a"]
    rows = list(enumerate(edge * 3))
    got = {(r.doc_id, r.start, r.stop, r.n_words) for r in substring_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == repeats_by_hand(rows)


def dropped_by(docs):
    return {r.row.doc_id: r.dropped for r in line_templates.drop_recurring_lines(docs).collect()}


def test_line_dedup_compares_tokens(spark):
    line = "Posted by user {} in the forum on {} morning with a total of {} replies and many views so far today"
    rows = [(1, line.format("alice", "Monday", "seven")), (2, line.format("bob", "Friday", "many"))]
    assert dropped_by(spark.createDataFrame(rows, "doc_id long, text string")) == {1: [], 2: [0]}


def test_line_dedup_makes_every_template_of_a_leaf(spark):
    families = ["This page was last edited on Monday by {} at noon", "This page was moved from another old place to {} today"]
    rows = [(i, "\n".join(f.format(x) for f in families)) for i, x in enumerate(["alice", "bob", "carol"])]
    rows += [(9, families[0].format("dora"))]
    assert dropped_by(spark.createDataFrame(rows, "doc_id long, text string")) == {0: [], 1: [0, 1], 2: [0, 1], 9: [0]}


@pytest.mark.parametrize("width", [8, 20])
def test_line_dedup_connects_alike_lines(spark, width):
    """Differences in one run and in several, chains of alike lines, leaves of many forms."""
    rng = np.random.default_rng(width)
    base = [list(rng.choice(list("uvwxyz"), 40)) for _ in range(6)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(10):
            words = list(base[rng.integers(6)][: rng.integers(1, width + 1)])
            for at in rng.integers(0, len(words), rng.integers(0, 1 + len(words) // 3)):
                words[at] = rng.choice(list("uvwxyz"))
            lines.append("a b c " + " ".join(words))
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(d, no) for d, nos in dropped_by(docs).items() for no in nos}
    assert got == lines_by_hand(rows)


def test_line_dedup_of_two_free_words(spark):
    """All combinations of two variable words in one leaf are one template, found without a round per template."""
    n = 115
    rows = [(i * n + j, f"alpha beta gamma x{chr(97 + i % 26)}{chr(97 + i // 26)} y{chr(97 + j % 26)}{chr(97 + j // 26)}") for i in range(n) for j in range(n)]
    out = line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    left = out.where(F.size("dropped") == 0).select("row.doc_id").collect()
    assert [r.doc_id for r in left] == [0]


def test_line_dedup_takes_lines_of_one_token(spark):
    rows = [(1, "Home\nhttp://a.org/1\n12"), (2, " Home\nhttp://a.org/2\n13\n没有空格的一行第3段"), (3, "http://a.org/1\n没有空格的一行第3段")]
    assert dropped_by(spark.createDataFrame(rows, "doc_id long, text string")) == {1: [], 2: [0], 3: [0, 1]}


def test_license_scan_reads_wrapped_notices(spark):
    notices = [
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and",
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        " * Permission to use, copy, modify, and/or\n * distribute this software for any\n *\n * purpose with or"
        "\n * without fee is hereby granted, provided",
        "Permission is hereby granted, free of charge, to any person\n\nobtaining a copy of this software",
    ]
    docs = spark.createDataFrame(list(enumerate(notices)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_join.scan(docs).collect()}
    assert got == {0: "mit", 1: "bsd", 2: "isc", 3: ""}


NOTICES_OVER_SENTENCES = [
    "Copyright 2020 Foo Inc. All rights reserved.",
    "Copyright 2020 Foo Inc.\nAll rights\nreserved! More.",
    "Copyright 2020 Foo Inc.\n \nAll rights reserved.",
    "Copyright of all. " + "Filler words here. " * 6 + "rights reserved",
    "Copyright of all. " + "Filler words here. " * 5 + "rights reserved",
    None,
    "",
]


def test_license_scan_reads_over_sentence_ends(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(list(enumerate(NOTICES_OVER_SENTENCES)), schema)
    got = {r.doc_id: (r.labels, r.score) for r in license_join.scan(docs).collect()}
    found = ("all-rights-reserved", 1.0)
    assert got == {0: found, 1: found, 2: ("", 0.0), 3: ("", 0.0), 4: found, 5: ("", 0.0), 6: ("", 0.0)}
    assert got == {r[0]: (r[6], r[7]) for r in in_sql(Q.ORACLE_SQL["op5_license_scan"], documents=docs)}


def in_sql(sql, **tables):
    """Rows of a SQL twin over small tables."""
    import duckdb

    c = duckdb.connect()
    for name, df in tables.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString().replace('string', 'varchar')}" for f in df.schema)
        c.execute(f"create table {name} ({columns})")
        for r in df.collect():
            c.execute(f"insert into {name} values ({', '.join('?' * len(r))})", list(r))
    return c.execute(sql).fetchall()


def test_stop_words_are_a_share_of_the_words(spark):
    plain = " ".join(f"{a}{b}{c}{d}" for a in "bdfgk" for b in "aeiou" for c in "mnprs" for d in ("ta", "lo"))  # 250 words
    rows = ["the of " + plain, "the of " * 4 + plain, "The Of " * 4 + "the of " + plain, ("the of " + plain + " ").upper() * 2]
    rows = [" ".join(t.split()) for t in rows]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.row.doc_id: (r.n_stop_kinds, r.n_stop_words, r.ok_stop_words, r.ok_stop_word_kinds) for r in quality_rules.judge(docs).collect()}
    assert got == {0: (2, 2, False, True), 1: (2, 8, True, True), 2: (2, 10, True, True), 3: (0, 4, False, False)}
    kept = {r.row.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    assert kept == {r[0]: r[7] for r in in_sql(Q.ORACLE_SQL["op8_quality_rules"], documents=docs)}


def test_matches_tell_their_places(spark):
    texts = ["one zebra and quagga graze here", "quagga far from a zebra", "quagga " + "x " * 60 + "zebra", None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    items = spark.createDataFrame([(7, "zebra and quagga"), (None, "quagga graze"), (8, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.kind, r.start, r.length) for r in phrase_index.matches(docs, items).collect()}
    phrase = {(0, "7", "phrase", 1, 3), (0, None, "phrase", 3, 2)}
    assert {m for m in got if m[2] == "phrase"} == phrase
    near = {m for m in got if m[2] == "proximity"}
    # the two rarest words of item 7 are "and" and one of zebra and quagga, which are equally frequent
    assert {m[:3] for m in near} == {(0, "7", "proximity")} and all(m[3] in (1, 2) and m[4] == 2 for m in near)
    wide = spark.createDataFrame([(9, "quagga zebra")], "item_id long, text string")
    got = sorted((r.doc_id, r.start, r.length) for r in phrase_index.matches(docs, wide).collect())
    assert got == [(0, 1, 3), (1, 0, 5)]
    assert phrase_index.matches(docs.where("false"), items).isEmpty() and phrase_index.matches(docs, items.where("false")).isEmpty()


def test_decontamination_counts_items_without_id(spark):
    docs = spark.createDataFrame([(1, "zebra and quagga graze"), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "zebra and quagga"), (7, "quagga graze")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids, r.contaminated) for r in phrase_index.contaminated(docs, items).collect()}
    assert got == {1: (4, ["7"], True), 2: (0, [], False)}
    only = phrase_index.contaminated(docs, items.where("item_id is null")).where("doc_id = 1").first()
    assert (only.n_hit, only.item_ids, only.contaminated, only.n_near) == (3, [], True, 0)
    twin = {r[0]: (r[2], r[3], r[5]) for r in in_sql(Q.ORACLE_SQL["op9_benchmark_decontamination"], documents=docs, benchmark=items)}
    assert twin == {1: (4, 1, True), 2: (0, 0, False)}
