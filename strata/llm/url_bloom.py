"""URL filter: blocked Bloom filter before an exact hash join, in DataFrame operations only.

Canonical URL: host in lower case without ``www.``, path without trailing
slashes, a trailing ``index`` page or ``.html``, query without tracking
parameters and in sorted order; scheme and fragment go.

The listed canonical URLs are hashed into blocks of 256 bits (four 64-bit
words, two bits set in each); a block is one row, made by ``bit_or``
aggregates. A URL whose bits are not all set in its block is not listed. The
possible hits alone go on to an equi-join with the list, which removes the
false positives. The blocks hold ``bits_per_url`` bits for each listed URL;
they are broadcast up to ``broadcast_bytes`` of memory, of which a block takes
up to 256 bytes in a hash relation, else joined by block number.

Rules (host, path prefix, verdict) come first: a rule fits its host and all
subdomains if the path starts with the rule's; the longest one wins.

Defined results: a NULL URL, or one without ``://``, has empty host and path,
no rule, and is never listed; a NULL list entry is no entry; every input row
gives one row, repeated rows too; extra columns are ignored; an empty list
allows all that no rule blocks, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

WORDS = 4
# memory of a block in a broadcast hash relation: its row of 56 bytes, its share of the key array (16 bytes a
# slot, two to four slots a key) and of pages that double as they grow
BLOCK_BYTES = 256
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query (without ``?``) as columns; empty where absent."""
    text = F.coalesce(url, F.lit(""))
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)(?:\\?([^#]*))?"
    host, path, query = (F.coalesce(F.regexp_extract(text, shape, i), F.lit("")) for i in (1, 2, 3))
    return ascii_lower(host), path, query


def canonical(url: Column) -> Column:
    """Canonical form, or NULL for a NULL URL or one without ``://``."""
    host, path, query = url_parts(url)
    stem = F.regexp_replace(path, "(/index)?(\\.html?)?/*$", "")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.when(
        F.instr(url, "://") > 0,
        F.concat(F.regexp_replace(host, "^www\\.", ""), stem, F.when(tail == "", "").otherwise(F.concat(F.lit("?"), tail))),
    )


def _place(url: Column, blocks: int) -> list[Column]:
    """Block number and the four words with the URL's bits."""
    bits = F.xxhash64(url, F.lit(1))

    def field(i: int) -> Column:
        return F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")

    one = F.lit(1).cast("bigint")
    words = [
        F.call_function("shiftleft", one, field(2 * i))
        .bitwiseOR(F.call_function("shiftleft", one, field(2 * i + 1)))
        .alias(f"bits{i}")
        for i in range(WORDS)
    ]
    return [F.pmod(F.xxhash64(url), F.lit(blocks)).alias("block"), *words]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, word0..word3) of the non-empty blocks of the canonical URLs in ``url``."""
    return (
        listed.select(*_place(F.col("url"), blocks))
        .groupBy("block")
        .agg(*[F.bit_or(f"bits{i}").alias(f"word{i}") for i in range(WORDS)])
    )


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[UrlRule, ...] = (),
    bits_per_url: int = 16,
    broadcast_bytes: int = 32_000_000,
) -> DataFrame:
    """page_id, host, path, rule, listed (boolean) and verdict of every row of ``pages``.

    ``listed`` has one column ``url`` of raw URLs to block.
    """
    urls = stored(
        listed.select(canonical(F.col("url")).alias("url")).where("url is not null").distinct(), "url-list"
    )
    blocks = max(1, -(-urls.count() * bits_per_url // 256))
    filter_rows = bloom_blocks(urls, blocks)
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        filter_rows = F.broadcast(filter_rows)

    host, path, _ = url_parts(F.col("url"))
    rows = pages.select(
        "page_id",
        host.alias("host"),
        path.alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):  # the longest is tested first
        fits = r.fits(F.col("host"), F.col("path"))
        rule, decided = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(decided)
    rows = rows.select("*", rule.alias("rule"), decided.alias("decided"), *_place(F.col("canonical"), blocks))
    inside = F.lit(True)
    for i in range(WORDS):
        inside = inside & (F.col(f"word{i}").bitwiseAND(F.col(f"bits{i}")) == F.col(f"bits{i}"))
    tested = rows.join(filter_rows, "block", "left").withColumn(
        "possible", F.coalesce(inside & F.col("canonical").isNotNull(), F.lit(False))
    )
    names = ["page_id", "host", "path", "rule", "decided"]
    absent = tested.where(~F.col("possible")).select(*names, F.lit(False).alias("listed"))
    hits = (
        tested.where("possible")
        .join(urls.withColumnRenamed("url", "_url"), F.col("canonical") == F.col("_url"), "left")
        .select(*names, F.col("_url").isNotNull().alias("listed"))
    )
    verdict = F.coalesce("decided", F.when(F.col("listed"), "block").otherwise("allow"))
    return absent.union(hits).select("page_id", "host", "path", "rule", "listed", verdict.alias("verdict"))


def thin_pages(pages: DataFrame, max_bytes: int = 1500) -> DataFrame:
    """URLs of the captures whose html has fewer than ``max_bytes`` bytes: a list the table itself gives."""
    return pages.where(F.coalesce(F.octet_length("html"), F.lit(0)) < max_bytes).select("url")
