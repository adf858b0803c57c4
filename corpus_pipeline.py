"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, BPE round trip.

Each stage is one operator of ``strata.llm`` with its production parameters:
``(spark, docs, sf_dir) -> DataFrame``. Stages but the last return the columns
of ``docs``; the last returns the encoded documents. A stage works on all that
its predecessor kept; ``run`` writes and rereads each result in the shared
folder, so a lost executor costs one stage at most.

Defined results: every stage takes NULLs in any column, empty and very long
texts, repeated rows and empty tables as its operator's docstring defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe_lexicon, line_templates, phrase_index, quality_rules, simhash_covering
from strata.llm.common import stored, table
from strata.llm.queries import digests, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go."""
    return quality_rules.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring line templates leave the texts, but for their earliest line."""
    return line_templates.dedup_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_covering.keep_one(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go."""
    return phrase_index.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of what is left, with their digests."""
    path = tokenizer_file()
    return digests(bpe_lexicon.decode(bpe_lexicon.encode(docs, path), path), "ids", "decoded")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("bpe_encoding", encode),
]

# Fingerprints, templates and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
