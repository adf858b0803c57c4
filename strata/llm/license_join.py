"""Licence scan as an exact set-similarity join, in DataFrame operations only.

Base phrases are found as consecutive words of a text. Beyond them, each text
is cut into paragraphs at its blank lines, and a paragraph into units at line
ends and sentence ends. A block is a unit with as many words of the units
behind it as the longest template has, so a notice may be wrapped anywhere and
may run over sentence ends. A block meets a template if it contains at least
``threshold`` of the template's distinct tokens. The join is exact:

- tokens are put in global order, rarest first, by the number of documents of
  the whole corpus they occur in;
- prefix filter: a template of m tokens that must share o = ceil(threshold * m)
  shares at least one of its first m - o + 1 tokens with a matching block;
- length filter: the block has at least o template tokens;
- positional filter: a match at template position i and block position j leaves
  room for at most min(m - i, size - j) common tokens;
- the overlap of the pairs left over is counted in full.

The templates are a fixed list, so their token table is a literal of the plan.
Blocks without a prefix token never leave the scan; the others keep their
template tokens only.

Defined results: NULL text has no words, no labels and score 0; every input
row gives one row, repeated rows alike; extra columns are ignored; an empty
table gives an empty result. ``score`` is the largest containment found, 1
with a base phrase.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NON_WORD_RUN, alnum_words, join_documents, row_key, stored

# Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of common notices, with the label each one gives.
TEMPLATES = (
    ("agpl", "gnu affero general public license"),
    ("all-rights-reserved", "copyright all rights reserved"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this program is free software you can redistribute it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("public-domain", "this work is dedicated to the public domain"),
)

PARAGRAPH_END = "\n[\\x20\\x09\\x0B-\\x0D]*\n"
UNIT_END = "\n|(?<=[.!?])[\\x20\\x09-\\x0D]+"


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _phrase_label(w: Column, i: Column, phrases: dict[str, str]) -> Column:
    """Label of the phrase whose words stand at ``i``, or NULL."""
    out = F.lit(None).cast("string")
    for phrase, label in phrases.items():
        here = F.lit(True)
        for j, word in enumerate(_words(phrase)):
            here = here & (F.get(w, i + j) == word)
        out = F.when(here, F.lit(label)).otherwise(out)
    return out


def _unit_words(unit: Column) -> Column:
    return F.array_remove(F.split(F.lower(unit), NON_WORD_RUN), "")


def _spans(units: Column, longest: int) -> Column:
    """Each unit's words with the next ``longest`` words of the units behind it; no unit is without words."""
    return F.transform(
        units, lambda x, i: F.concat(x, F.slice(F.flatten(F.slice(units, i + 2, longest)), 1, longest))
    )


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = BASE_PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = 0.9,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    sets = [(label, sorted(set(_words(text)))) for label, text in templates]
    longest = max(len(_words(text)) for _, text in templates)
    vocabulary = sorted({t for _, tokens in sets for t in tokens})
    words = docs.select("doc_id", "text", row_key().alias("_key"), alnum_words(F.col("text")).alias("w"))

    counted = dict(
        words.select(F.explode(F.array_intersect("w", _strings(vocabulary))).alias("t"))
        .groupBy("t")
        .agg(F.count(F.lit(1)))
        .collect()  # at most one row for each token of the fixed templates
    )
    order = sorted(vocabulary, key=lambda t: (counted.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    entries = []  # (token, template number, position, size, needed overlap)
    for number, (_, tokens) in enumerate(sets):
        tokens.sort(key=rank.__getitem__)
        need = math.ceil(threshold * len(tokens) - 1e-9)
        entries += [(t, number, i, len(tokens), need) for i, t in enumerate(tokens[: len(tokens) - need + 1])]
    prefix = sorted({e[0] for e in entries})

    starts = sorted({_words(p)[0] for p in phrases})
    w, n = F.col("w"), F.size("w")
    marks = F.when(
        F.arrays_overlap(w, _strings(starts)),
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: _phrase_label(w, i, phrases)),
    )
    first = words.select(
        "doc_id",
        "_key",
        n.cast("bigint").alias("n_words"),
        marks.alias("marks"),
        F.when(F.arrays_overlap(w, _strings(prefix)), F.split("text", PARAGRAPH_END)).alias("paragraphs"),
    )
    m = F.col("marks")
    places = F.filter(F.transform(m, lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull())
    base = stored(
        first.select("doc_id", "_key", "n_words", places.alias("places"), F.array_compact("marks").alias("found"), "paragraphs"),
        "license-base",
    )

    # blocks as their template tokens in global order: array_intersect keeps the order of its first side
    tokens = (
        base.where("paragraphs is not null")
        .select("_key", "doc_id", F.explode("paragraphs").alias("paragraph"))
        .select("_key", "doc_id", F.transform(F.split("paragraph", UNIT_END), _unit_words).alias("units"))
        .where(F.arrays_overlap(F.flatten("units"), _strings(prefix)))
        .select("_key", "doc_id", F.explode(_spans(F.filter("units", lambda x: F.size(x) > 0), longest)).alias("span"))
        .select("_key", "doc_id", F.array_intersect(_strings(order), "span").alias("tokens"))
        .where(F.arrays_overlap("tokens", _strings(prefix)))
        .distinct()
    )
    index = docs.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(t).alias("token"),
                        F.lit(number).alias("template"),
                        F.lit(i).alias("i"),
                        F.lit(size).alias("m"),
                        F.lit(need).alias("need"),
                    )
                    for t, number, i, size, need in entries
                ]
            )
        )
    )
    sides = F.array(*[_strings(t) for _, t in sets])
    room = F.least(F.col("m") - F.col("i"), F.size("tokens") - F.col("j"))
    matched = (
        tokens.select("_key", "doc_id", "tokens", F.posexplode("tokens").alias("j", "token"))
        .join(F.broadcast(index), "token")
        .where((F.size("tokens") >= F.col("need")) & (room >= F.col("need")))
        .withColumn("common", F.size(F.array_intersect("tokens", sides[F.col("template")])))
        .where("common >= need")
        .select(
            "_key",
            "doc_id",
            _strings([label for label, _ in sets])[F.col("template")].alias("label"),
            (F.col("common") / F.col("m")).alias("containment"),
        )
    )
    per_doc = matched.groupBy("_key", "doc_id").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("containment")
    )
    none = F.array().cast("array<string>")
    found = F.coalesce("found", none)
    p = F.col("places")
    return join_documents(base, per_doc, "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size(found), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(p).cast("bigint").alias("first_word"),
        F.array_max(p).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(found)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(found, F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size(found) > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )

