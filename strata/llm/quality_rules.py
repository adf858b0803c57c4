"""Quality rules: a table of thresholds compiled into column expressions.

Every measure is a built-in expression over the row's own text, so scoring is
one narrow projection: no user function, no shuffle, no limit on text length.

Words are runs of non-blank characters. Repeated words are those covered by a
three-word window that occurs at least twice in the text; windows are compared
by a 64-bit hash within one document. Function words must make up a share of
the words, in any case of letters, and two different ones must stand in lower
case: texts wholly in capitals are rejected, as are texts of 50 words or more
in languages without these function words.

Defined results: NULL text counts as empty (no word; rejected as too short);
rows are judged one by one, so repeated rows and NULL ids get equal verdicts;
columns of the input, whatever their names, pass through ``filter_documents``
untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, blank_words

# Frequent function words of English, German, French, Spanish.
STOP_WORDS = (
    "the be to of and that have with "
    "der die und den das von zu mit "
    "le la les de et des en un que "
    "el los las y del se por con"
).split()

BULLETS = "^[\\x20\\x09]*[-*•●‣]"


@dataclass(frozen=True)
class Rule:
    """Keep documents whose ``numerator / denominator`` lies within [low, high]."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None = None
    high: float | None = None

    def passed(self) -> Column:
        top = F.col(self.numerator).cast("double")
        value = top if self.denominator is None else top / F.greatest(F.col(self.denominator), F.lit(1))
        tests = [value >= F.lit(self.low)] if self.low is not None else []
        tests += [value <= F.lit(self.high)] if self.high is not None else []
        out = F.lit(True)
        for t in tests:
            out = out & t
        return out


DEFAULT_RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_kinds", "n_stop_kinds", None, 2.0, None),
    Rule("stop_words", "n_stop_words", "n_words", 0.03, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
)


def _repeat_words(grams: str) -> tuple[Column, Column, Column]:
    """Steps from the array of window hashes to the number of words they cover."""
    g = F.col(grams)
    # only texts with a repeated hash pay for the sort
    sorted_pairs = F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    z = F.col("_pairs")
    twins = F.zip_with(
        F.slice(z, 1, F.size(z) - 1),
        F.slice(z, 2, F.size(z) - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull()))))
    s = F.col("_starts")
    steps = F.zip_with(
        F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.least(F.lit(3), b - a)
    )
    covered = F.aggregate(steps, F.lit(3), lambda acc, x: acc + x)
    return sorted_pairs, starts, F.coalesce(covered, F.lit(0)).cast("bigint")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Input rows as column ``row`` plus one column per measure."""
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    worded = base.withColumn("_words", blank_words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    )
    w, lines = F.col("_words"), F.col("_lines")
    n = F.size(w)
    grams = F.when(
        n >= 3,
        F.transform(
            F.arrays_zip(
                F.slice(w, 1, n - 2).alias("a"), F.slice(w, 2, n - 2).alias("b"), F.slice(w, 3, n - 2).alias("c")
            ),
            lambda x: F.xxhash64(x),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    counted = worded.select(
        "row",
        n.cast("bigint").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.size(F.split("_text", "[#*$%&|<>]", -1)) - 1).cast("bigint").alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(BULLETS))).cast("bigint").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))
        .cast("bigint")
        .alias("n_ellipsis_lines"),
        F.size(F.array_intersect(w, F.array(*[F.lit(s) for s in STOP_WORDS]))).cast("bigint").alias("n_stop_kinds"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("bigint").alias("n_stop_words"),
        grams.alias("_grams"),
    )
    pairs, starts, covered = _repeat_words("_grams")
    return (
        counted.withColumn("_pairs", pairs)
        .withColumn("_starts", starts)
        .withColumn("n_repeat_words", covered)
        .drop("_grams", "_pairs", "_starts")
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """``measure`` plus ``base_failed``, one ``ok_<rule>`` per rule, and ``kept``."""
    m = measure(docs, text)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~F.col("base_failed")
    for r in rules:
        kept = kept & F.col(f"ok_{r.name}")
    return m.withColumns(
        {"base_failed": failed} | {f"ok_{r.name}": r.passed() for r in rules}
    ).withColumn("kept", kept)


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """The input's own columns of the documents that are kept."""
    # the optimizer moves no filter below a random column: else it would repeat the measures, which build
    # on each other, many times over inside the test
    judged = judge(docs, rules, text).withColumn("_draw", F.rand(0))
    kept = judged.where(F.col("kept") & (F.col("_draw") >= 0))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
