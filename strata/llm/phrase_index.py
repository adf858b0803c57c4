"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Index. Both sides are cut into lower-cased words. The terms of the test items
are counted over the whole training corpus. A test phrase is a window of
``window`` consecutive item words (an item that is shorter, but not empty, is
one phrase); each phrase is looked up by its two rarest terms. The postings of
these terms (term, document, position and the words around it) are stored in
the shared folder, with one end marker per document whose position is the
document's word count.

Search. A posting of the rarest term of a phrase, minus the term's offset,
gives a start; the second rarest term must stand at its own offset from that
start, and the remaining words must follow: an exact phrase match. Proximity:
both terms stand within ``slop`` words of each other, in any order, whatever
the words between them; it is reported, and decides nothing. ``matches``
returns the places of both kinds.

Scale. The test items are taken in blocks of at most ``block_terms`` lookup
terms, so what is broadcast has a stated bound; there is one block unless the
benchmark is large. Postings outside the lookup terms never leave the scan.
Hits are merged per document; no pairs of documents are formed.

Defined results: NULL or wordless texts have no words and no hit; items
without words are not looked up; the words of items without an id are hit, but
no id is listed or counted for them; repeated rows (documents or
items) give equal results row by row; extra columns are ignored or passed
through; empty tables give no hit, or no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, join_documents, row_key, stored

END = "\x00end"  # no word holds this character


def phrases(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, words): the distinct test phrases."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), alnum_words(F.col("text")).alias("w")
    ).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (
        items.select("item_id", "w", F.explode(starts).alias("at"))
        .select("item_id", F.slice("w", F.col("at"), window).alias("words"))
        .distinct()
    )


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", row_key().alias("_key"), alnum_words(F.col("text")).alias("w"))


def lookup_terms(docs: DataFrame, tests: DataFrame, block_terms: int) -> DataFrame:
    """Each phrase with its rarest (t1 at o1) and second rarest (t2 at o2) term and its block of terms."""
    terms = tests.select(F.explode("words").alias("term")).distinct()
    frequency = None
    # the terms in slices of a stated size: one pass over the corpus counts a slice
    slices = max(1, -(-terms.count() // (8 * block_terms)))
    for i in range(slices):
        part = terms.where(F.pmod(F.xxhash64("term"), F.lit(slices)) == i)
        counted = (
            _tokens(docs)
            .select(F.explode("w").alias("term"))
            .join(F.broadcast(part), "term")
            .groupBy("term")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        frequency = counted if frequency is None else frequency.union(counted)
    places = tests.select("item_id", "words", F.posexplode("words").alias("o", "term"))
    ranked = places.join(frequency, "term", "left").groupBy("item_id", "words").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "o", "term"))).alias("r")
    )
    picked = ranked.select(
        "item_id",
        "words",
        F.col("r")[0]["term"].alias("t1"),
        F.col("r")[0]["o"].alias("o1"),
        F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])["term"].alias("t2"),
        F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])["o"].alias("o2"),
        F.col("r")[0]["n"].alias("n1"),
    )
    return stored(picked, "phrase-lookups")


def postings(docs: DataFrame, lookups: DataFrame, window: int, block_terms: int) -> DataFrame:
    """Stored index: (term, doc_id, _key, pos, before, around) of the lookup terms, and the end markers."""
    terms = (
        lookups.where("n1 > 0")
        .select(F.explode(F.array("t1", "t2")).alias("term"))
        .distinct()
    )
    blocks = max(1, -(-terms.count() // block_terms))
    spread = _tokens(docs).select(
        "doc_id", "_key", "w", F.posexplode(F.concat("w", F.array(F.lit(END)))).alias("pos", "term")
    )
    out = None
    for i in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i)
        if i == 0:
            part = part.union(docs.sparkSession.range(1).select(F.lit(END).alias("term")))
        first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
        hits = spread.join(F.broadcast(part), "term").select(
            "term",
            "doc_id",
            "_key",
            "pos",
            (F.col("pos") - first).alias("before"),
            F.when(F.col("term") != END, F.slice("w", first + 1, 2 * window - 1)).alias("around"),
        )
        out = hits if out is None else out.union(hits)
    return stored(out, "phrase-postings")


def find(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 50, block_terms: int = 100_000) -> DataFrame:
    """Per document row: n_words, n_hit, item_ids (sorted strings) of exact phrases, n_near items by proximity."""
    lookups = lookup_terms(docs, phrases(benchmark, window), block_terms)
    index = postings(docs, lookups, window, block_terms)
    marks = index.where(F.col("term") == END).select("doc_id", "_key", F.col("pos").cast("bigint").alias("n_words"))

    exact = exact_matches(index, lookups)
    spans = (
        exact.groupBy("_key", "doc_id", "start")
        .agg(F.max("length").alias("len"))
        .groupBy("_key", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("spans"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(s["start"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
        ),
        lambda acc: acc["n"].cast("bigint"),
    )
    items = exact.select("_key", "doc_id", "item_id").distinct().groupBy("_key", "doc_id").agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids")
    )
    near = (
        near_matches(index, lookups, slop)
        .select("_key", "doc_id", "item_id")
        .distinct()
        .groupBy("_key", "doc_id")
        .agg(F.count(F.lit(1)).alias("n_near"))
    )
    out = marks
    for found in (spans.select("_key", "doc_id", covered.alias("n_hit")), items, near):
        out = join_documents(out, found, "left")
    return out.select(
        "doc_id",
        "_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 50, block_terms: int = 100_000) -> DataFrame:
    """doc_id, _key, item_id, kind, start, length: where test items stand in the documents, in words from 0.

    ``kind`` is ``phrase`` for each exact phrase, and ``proximity`` for the
    shortest stretch around both lookup terms in each cell of ``slop`` + 1
    words. Repeated rows of a document share their matches.
    """
    lookups = lookup_terms(docs, phrases(benchmark, window), block_terms)
    index = postings(docs, lookups, window, block_terms)
    kinds = (("phrase", exact_matches(index, lookups)), ("proximity", near_matches(index, lookups, slop)))
    phrase, near = (
        rows.select("doc_id", "_key", "item_id", F.lit(kind).alias("kind"), "start", "length").distinct()
        for kind, rows in kinds
    )
    return phrase.unionByName(near)


def exact_matches(index: DataFrame, lookups: DataFrame) -> DataFrame:
    """(_key, doc_id, item_id, start, length): phrases whose words all stand at their offsets from the rarest term."""
    by_phrase = index.join(lookups.withColumnRenamed("t1", "term"), "term")
    here = F.col("before") - F.col("o1")
    at = (F.col("pos") - F.col("o1")).alias("start")
    return (
        by_phrase.where(here >= 0)
        .where(F.get("around", here + F.col("o2")) == F.col("t2"))
        .where(F.slice("around", F.greatest(here, F.lit(0)) + 1, F.size("words")) == F.col("words"))
        .select("_key", "doc_id", "item_id", at, F.size("words").alias("length"))
    )


def near_matches(index: DataFrame, lookups: DataFrame, slop: int) -> DataFrame:
    """(_key, doc_id, item_id, start, length): phrases whose two rarest terms stand within ``slop`` words of each other.

    Positions are put into cells of ``slop`` + 1 words; two terms are near if
    they share a cell or stand in neighbouring cells with a gap in range, which
    the smallest and largest position of each term in a cell decide.
    """
    pair = lookups.where("item_id is not null").select("item_id", "t1", "t2").distinct()
    sides = F.array(*[F.struct(F.lit(k).alias("side"), F.col(f"t{k}").alias("term")) for k in (1, 2)])
    wanted = pair.select("item_id", "t1", "t2", F.explode(sides).alias("x"))
    cell = F.floor(F.col("pos") / F.lit(slop + 1)).cast("int")
    ends = (
        index.where(F.col("term") != END)
        .join(wanted.select("item_id", "t1", "t2", "x.side", "x.term"), "term")
        .groupBy("_key", "doc_id", "item_id", "t1", "t2", cell.alias("cell"), "side")
        .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    )
    # the last position in a cell also stands before the next cell
    both = ends.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("ahead")).withColumn(
        "cell", F.col("cell") + F.col("ahead")
    )

    def end(what, value, side, ahead):
        return what(F.when((F.col("side") == side) & (F.col("ahead") == ahead), F.col(value)))

    met = both.groupBy("_key", "doc_id", "item_id", "t1", "t2", "cell").agg(
        *[end(F.min, "lo", k, 0).alias(f"lo{k}") for k in (1, 2)],
        *[end(F.max, "hi", k, 1).alias(f"prev{k}") for k in (1, 2)],
    )

    def stretch(a: str, b: str):
        """Length and start of the words from one position to the other, if they are near."""
        gap = F.abs(F.col(a) - F.col(b))
        return F.when(gap <= slop, F.struct((gap + 1).alias("length"), F.least(a, b).alias("start")))

    best = F.array_min(F.array(stretch("lo1", "lo2"), stretch("lo1", "prev2"), stretch("lo2", "prev1")))
    return (
        met.withColumn("best", best)
        .where("best is not null")
        .select("_key", "doc_id", "item_id", F.col("best.start").alias("start"), F.col("best.length").alias("length"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``find`` plus the verdict: at least one twentieth of the words are hit."""
    return find(docs, benchmark, **parameters).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The input's own columns of the documents that are not contaminated."""
    bad = (
        contaminated(docs.select("doc_id", "text"), benchmark, **parameters)
        .where("contaminated")
        .select("_key", "doc_id")
        .distinct()
    ).hint("shuffle_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("_row_key")
    )
    return join_documents(rows, bad, "left_anti", "_row_key", "row.doc_id").select(
        *[F.col("row")[c].alias(c) for c in docs.columns]
    )
