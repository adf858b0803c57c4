"""Registered queries of the operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_lexicon,
    license_join,
    line_templates,
    oracle,
    phrase_index,
    quality_knn,
    quality_rules,
    simhash_covering,
    substring_dedup,
    token_alignment,
    url_bloom,
    vector_packing,
    warc_index,
    whitening,
)
from .common import table


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Host, path prefix and verdict of the rules for pages.
URL_RULES = (
    url_bloom.UrlRule("org", "/", "allow"),
    url_bloom.UrlRule("example.org", "/es/", "block"),
    url_bloom.UrlRule("example.org", "/en/1", "block"),
    url_bloom.UrlRule("com", "/fr/", "allow"),
    url_bloom.UrlRule("com", "/de/", "block"),
)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per removed span, with the place where its first unit occurs first."""
    return substring_dedup.repeats(table(spark, sf_dir, "documents")).drop("_key")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_covering.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_knn.score(docs, quality_knn.fit(docs, table(spark, sf_dir, "labels")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        F.size("dropped").cast("bigint").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped"),
        "text",
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(table(spark, sf_dir, "documents"))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 digests of ids and decoded text, with the columns to keep."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        *keep,
    )


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file()
    return digests(bpe_lexicon.decode(bpe_lexicon.encode(table(spark, sf_dir, "documents"), path), path))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are archived, indexed, and read back through the index."""
    captures, shards = warc_index.archive(spark, table(spark, sf_dir, "pages"))
    return warc_index.lookup(captures, shards)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_index.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
        "n_near",
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the URLs of captures with next to no content."""
    pages = table(spark, sf_dir, "pages")
    return url_bloom.filter_urls(pages, url_bloom.thin_pages(pages), URL_RULES)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, cut where a sequence has room, each id loss-bearing."""
    examples = vector_packing.document_examples(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=1)
    return vector_packing.pack(examples, vector_packing.Limits(tokens=2048, segments=64, loss_tokens=2048)).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_alignment.measure(docs, tokenizer_file(), tokenizer_file("piece_bpe_32k.model"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", components=16)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return out.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_simhash_near_dedup,
        op3_quality_classifier,
        op4_line_dedup,
        op5_license_scan,
        op6_bpe_round_trip,
        op7_warc,
        op8_quality_rules,
        op9_benchmark_decontamination,
        op10_url_filter,
        op11_packing,
        op12_token_alignment,
        op13_embedding_whitening,
    )
}
ORACLE_SQL = {
    "op1_substring_dedup": oracle.SUBSTRINGS,
    "op4_line_dedup": oracle.LINES,
    "op5_license_scan": oracle.license_sql(license_join.BASE_PHRASES, license_join.TEMPLATES, 0.9),
    "op7_warc": oracle.WARC,
    "op8_quality_rules": oracle.QUALITY,
    "op9_benchmark_decontamination": oracle.DECONTAMINATION,
    "op10_url_filter": oracle.url_sql(URL_RULES, 1500),
}
