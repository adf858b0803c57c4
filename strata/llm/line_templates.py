"""Line dedup with a log-template tree of fixed depth, in DataFrame operations only.

Parsing. A line is split into tokens at blanks; a token with a digit becomes
the wildcard ``<*>``, but for a line of this one token, which keeps its raw
text. The tree has two levels above its leaves: the token
count, then the ``depth`` leading tokens. In a leaf, two lines are alike when
at least ``similarity`` of their tokens agree, place by place. A template is
what like lines connect: lines joined by a chain of alike ones, whose differing
tokens are its variable fields.

Dropping. A template found in at least two documents recurs; its earliest line
(smallest doc_id, then line number) stays, every other line of it is dropped
from its text. Lines of fewer than ``min_tokens`` tokens are never dropped; the
default of 1 spares none.

Scale. What is shuffled are hashes of lines, and once an integer per token to
find the tokens of the forms in leaves of several forms: counts per form are
partial aggregates, so a line in a third of all documents shrinks before the
shuffle; the joins back are plain equi-joins that adaptive execution may split.
The text is shuffled once, beside the list of dropped line numbers of its own
document. Forms are connected in two steps, on one path at every size. Forms
that are equal outside one run of as many tokens as alike forms may differ in
are alike: each is linked to the first of its group, so no pairs are formed.
Other alike forms have one of several runs in common. There, in ``HUB_ROUNDS``
rounds, every form meets one form of its group, which joins large families
without pairs; what is then still in different groups is paired, in cells of
bounded size and past a test of four bit sketches that no alike pair fails.
Tokens decide. The links are contracted by ``components`` in a logarithmic
number of rounds.

Defined results: NULL text stays NULL and has no line; rows equal in doc_id
and text count as one document and keep the same lines; rows without doc_id
come last in the order; extra input columns pass through; an empty table gives
an empty result; a text whose lines are all dropped becomes empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import salted_self_join
from .common import BLANK_RUN, BLANKS, join_documents, row_key, stored
from .simhash_covering import components

WILDCARD = "<*>"

HUB_ROUNDS = 2
SKETCHES = 4  # one bit of each token's hash goes into each of so many 64-bit sketches


def parse_lines(docs: DataFrame, depth: int) -> DataFrame:
    """One row per line: key and order of its document, line number, token count, leaf, form, hashed tokens."""
    lines = docs.select(
        row_key().alias("_key"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "_line")
    ).where(F.btrim("_line", F.lit(BLANKS)) != "")
    masked = F.when(
        F.col("_line").rlike("[0-9]"),
        F.regexp_replace("_line", "[^\\x20\\x09-\\x0D]*[0-9][^\\x20\\x09-\\x0D]*", WILDCARD),
    ).otherwise(F.col("_line"))
    # a line that is nothing but a wildcard keeps its raw text: equal lines recur, other numbers and URLs stay
    line = F.btrim(masked, F.lit(BLANKS))
    line = F.when(line == WILDCARD, F.btrim("_line", F.lit(BLANKS))).otherwise(line)
    tokens = lines.select("_key", "doc_id", "line_no", F.split(line, BLANK_RUN).alias("_t"))
    t, n = F.col("_t"), F.size("_t")
    return tokens.select(
        "_key",
        "doc_id",
        "line_no",
        n.alias("n_tokens"),
        F.xxhash64(n, F.slice(t, 1, depth)).alias("leaf"),
        F.xxhash64(t).alias("form"),
        F.transform(t, lambda x: F.hash(x)).alias("tokens"),
    )


def _alike(a: str, b: str, similarity: float) -> Column:
    """Whether the forms agree in ``similarity`` of their tokens, place by place."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return same >= F.lit(similarity) * F.size(a)


def _may_differ(similarity: float) -> Column:
    """In how many tokens alike forms may differ."""
    return F.floor(F.size("tokens") * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")


def _without_a_run(forms: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(form, key): equal keys mean forms equal outside one run of the places in which alike forms may differ."""
    t, n, d = F.col("tokens"), F.size("tokens"), F.col("d")
    free = F.greatest(n - depth, F.lit(0))

    def key(j):
        at = F.least(F.lit(depth), n) + j * d
        return F.xxhash64("leaf", j, F.slice(t, 1, at), F.slice(t, F.least(at + d, n) + 1, n))

    keys = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(free / d).cast("int") - 1, F.lit(0))), key)
    return forms.withColumn("d", _may_differ(similarity)).where("d > 0").select("form", F.explode(keys).alias("key"))


def _shared_runs(forms: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(form, comp, key): one run of tokens more than alike forms may differ in, so one is equal in both."""
    n, d = F.size("tokens"), F.col("d")
    free = F.greatest(n - depth, F.lit(0))

    def run(j):
        at = F.floor(free * j / (d + 1)).cast("int")
        end = F.floor(free * (j + 1) / (d + 1)).cast("int")
        return F.xxhash64("leaf", j, F.slice("tokens", depth + 1 + at, end - at))

    # up to one difference lies in one run: such forms have met already
    open_forms = forms.withColumn("d", _may_differ(similarity)).where("d > 1")
    return open_forms.select("form", "comp", F.explode(F.transform(F.sequence(F.lit(0), d), run)).alias("key"))


def _sketches(forms: DataFrame, similarity: float) -> DataFrame:
    """(form, d, sketch_*): a token's hash adds a bit to each sketch, at its place modulo 64.

    Forms that differ in d tokens differ in at most d places of the sketches taken together.
    """

    def sketch(k):
        bits = F.transform(
            "tokens",
            lambda x, i: F.call_function(
                "shiftleft", F.shiftrightunsigned(x, 7 * k).bitwiseAND(F.lit(1)).cast("bigint"), F.pmod(i, F.lit(64))
            ),
        )
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseXOR(x)).alias(f"sketch_{k}")

    return forms.select("form", _may_differ(similarity).alias("d"), *[sketch(k) for k in range(SKETCHES)])


def _may_be_alike() -> Column:
    """Rows a and b, of different groups, whose sketches do not rule it out."""
    differ = F.lit(0).cast("bigint")
    for k in range(SKETCHES):
        differ = differ.bitwiseOR(F.col(f"a.sketch_{k}").bitwiseXOR(F.col(f"b.sketch_{k}")))
    return (F.col("a.comp") != F.col("b.comp")) & (F.bit_count(differ) <= F.col("a.d"))


def _several_groups(runs: DataFrame) -> DataFrame:
    """The rows of ``runs`` whose key stands in more than one group."""
    ends = runs.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    return stored(runs.join(stored(ends.select("key"), "line-keys-of-groups"), "key", "left_semi"), "line-open-runs")


def _alike_groups(near: DataFrame, forms: DataFrame, similarity: float) -> DataFrame:
    """(a, b): groups of the pairs of forms (a, b, comp_a, comp_b) whose tokens are alike."""
    sides = [forms.select(F.col("form").alias(x), F.col("tokens").alias(f"tokens_{x}")) for x in "ab"]
    return (
        stored(near.distinct(), "line-pairs")
        .join(sides[0], "a")
        .join(sides[1], "b")
        .where(_alike("tokens_a", "tokens_b", similarity))
        .select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    )


def _pair() -> list[Column]:
    return [F.col("a.form").alias("a"), F.col("b.form").alias("b"), F.col("a.comp").alias("comp_a"), F.col("b.comp").alias("comp_b")]


def _relabelled(rows: DataFrame, root: DataFrame) -> DataFrame:
    """``rows`` with the group of their group."""
    names = [c for c in rows.columns if c != "comp"]
    return rows.join(root, rows.comp == root.node, "left").select(*names, F.coalesce("root", "comp").alias("comp"))


def form_templates(forms: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(form, template) of the forms (leaf, form, tokens): forms connected by alike ones have one template."""
    keys = stored(_without_a_run(forms, depth, similarity), "line-keys")
    hubs = stored(
        keys.groupBy("key").agg(F.min("form").alias("hub"), F.max("form").alias("last")).where("hub <> last"), "line-hubs"
    )
    stars = keys.join(hubs, "key").select(F.col("form").alias("a"), F.col("hub").alias("b"))
    grouped = stored(
        _relabelled(forms.withColumn("comp", F.col("form")), components(stars, "line-groups")), "line-grouped"
    )
    runs = _several_groups(stored(_shared_runs(grouped, depth, similarity), "line-runs"))
    wanted = stored(grouped.select("form", "tokens").join(runs.select("form").distinct(), "form", "left_semi"), "line-open-forms")
    runs = stored(runs.join(stored(_sketches(wanted, similarity), "line-sketches"), "form"), "line-open-runs")
    of = grouped.select("form", "comp")
    for turn in range(HUB_ROUNDS + 1):
        if runs.isEmpty():
            break
        if turn < HUB_ROUNDS:
            first = F.min(F.struct(F.xxhash64(F.lit(turn), "form").alias("order"), "form", "comp", *[f"sketch_{k}" for k in range(SKETCHES)]))
            hubs = stored(runs.groupBy("key").agg(first.alias("hub")).select("key", "hub.*").drop("order"), "line-hubs")
            met = runs.alias("a").join(hubs.alias("b"), F.col("a.key") == F.col("b.key")).where(_may_be_alike())
        else:
            met = salted_self_join(runs, ["key"], "form", (F.col("a.form") < F.col("b.form")) & _may_be_alike())
        root = components(_alike_groups(met.select(*_pair()), wanted, similarity), "line-joined-groups")
        of = stored(_relabelled(of, root), "line-groups-of-forms")
        if turn < HUB_ROUNDS:
            runs = _several_groups(stored(_relabelled(runs, root), "line-runs"))
    return of.select("form", F.col("comp").alias("template"))


def dropped_lines(
    docs: DataFrame, depth: int = 3, similarity: float = 0.75, min_tokens: int = 1
) -> DataFrame:
    """(_key, doc_id, dropped: array of line numbers) of the documents that lose lines."""
    every = stored(parse_lines(docs, depth), "line-leaves").where(F.col("n_tokens") >= min_tokens)
    # a template can recur only in a leaf that recurs: one small row per leaf and task decides that
    leaves = every.groupBy("leaf").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).where("lo <> hi")
    # stored, so that a hot leaf's lines may be split in the join
    leaves = stored(leaves.select("leaf"), "line-leaves-of-several-documents")
    lines = stored(every.drop("n_tokens", "tokens").join(leaves, "leaf", "left_semi"), "line-recurring-leaves")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_key"), F.col("line_no"))
    forms = stored(
        lines.groupBy("leaf", "form").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(place).alias("earliest"),
            F.min("_key").alias("lo"),
            F.max("_key").alias("hi"),
        ),
        "line-forms",
    )
    # tokens are needed where a leaf has more than one form
    several = stored(
        forms.groupBy("leaf").agg(F.min("form").alias("lo"), F.max("form").alias("hi")).where("lo <> hi").select("leaf"),
        "line-leaves-of-several-forms",
    )
    wanted = stored(forms.select("leaf", "form").join(several, "leaf", "left_semi"), "line-several-forms")
    found = stored(
        every.select("leaf", "form", "tokens").join(wanted.hint("shuffle_hash"), ["leaf", "form"], "left_semi"),
        "line-form-tokens",
    )
    tokens = stored(
        found.groupBy("form").agg(F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens")), "line-tokens"
    )
    of = form_templates(tokens, depth, similarity)
    templates = stored(
        forms.join(of, "form", "left").withColumn("template", F.coalesce("template", "form")), "line-templates"
    )
    recurring = (
        templates.groupBy("leaf", "template")
        .agg(F.min("earliest").alias("kept"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where("lo <> hi")
        .select("leaf", "template", "kept")
    )
    kept = templates.select("leaf", "form", "template").join(recurring, ["leaf", "template"])
    return (
        lines.join(kept.select("leaf", "form", "kept"), ["leaf", "form"])
        .where(
            (F.col("kept._key") != F.col("_key"))
            | ~F.col("kept.doc_id").eqNullSafe(F.col("doc_id"))
            | (F.col("kept.line_no") != F.col("line_no"))
        )
        .groupBy("_key", "doc_id")
        .agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def drop_recurring_lines(docs: DataFrame, **parameters) -> DataFrame:
    """Input rows as ``row``, the ``text`` without its dropped lines, ``n_lines`` and the ``dropped`` line numbers."""
    # the list side is built into the hash table: documents are not sorted
    lost = dropped_lines(docs.select("doc_id", "text"), **parameters).hint("shuffle_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key().alias("_row_key")
    )
    joined = join_documents(rows, lost, "left", "_row_key", "row.doc_id").select(
        "row", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")
    )
    lines = joined.withColumn("_lines", F.split(F.col("row.text"), "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("dropped"))
    text = F.when(F.size("dropped") == 0, F.col("row.text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.col("_lines")[i]), "\n")
    )
    return lines.select(
        "row",
        text.alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        "dropped",
    )


def dedup_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The input's own columns, with ``text`` (and ``n_chars``, where present) as the dedup leaves them."""
    out = drop_recurring_lines(docs, **parameters)
    changed = F.size("dropped") > 0
    value = {
        "text": F.col("text"),
        "n_chars": F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("row")["n_chars"])
        if "n_chars" in docs.columns
        else None,
    }
    return out.select(*[value.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
