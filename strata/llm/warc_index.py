"""WARC archives with a two-level capture index.

Writing. Each task writes its rows as gzip members, one record each, to WARC
files of its own in a shared folder (any file system pyarrow opens) and returns
one capture row per record; a failed attempt's files are never referred to. Of
the records with equal payloads (SHA-1 and length) of at least ``min_bytes``
bytes, the one with the largest page_id is the response and the others are
revisits without payload; shorter payloads are all responses.

Index. A capture's key is its URL with reversed host, then its page_id (in the
place of a timestamp). Captures are range-partitioned and sorted by key; each
partition writes one shard: compressed blocks of ``block_lines`` lines, and a
sparse directory with the first key, offset and length of each block. The list
of shards has one row per partition; only that list is broadcast.

Lookup. A key is searched by bisection among the shards' first keys, then in
the shard's directory; one range read brings its block, a bisection its lines,
and one range read per line its record. A revisit is resolved by looking up
the response that it names, the one with its payload digest. Requests come sorted, so the few directories and
blocks that a task holds at a time serve many of them.

Defined results: NULL html is an empty payload; NULL or shapeless URLs share
the key of the empty host; rows without page_id are never named by a revisit
(equal payloads that all lack an id are all responses); repeated rows are
records of their own, responses if their page_id is the largest; extra columns
are ignored; an empty table gives empty archives and an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import state_path
from .common import stored
from .url_bloom import url_parts

LEVEL = 3
NO_ID = "-" * 20
CAPTURE = "page_id bigint, key string, file string, offset bigint, length bigint, record_type string"


def capture_key(url: Column, page_id: Column) -> Column:
    """Reversed host, path and query, then the page_id as 20 digits."""
    host, path, query = url_parts(url)
    turned = F.array_join(F.reverse(F.split(host, "\\.")), ",")
    rest = F.concat(path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    address = F.regexp_replace(F.concat(turned, F.lit(")"), rest), "[\\x00-\\x20\\x7F]", "%20")
    number = page_id.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")
    return F.concat_ws(" ", address, F.coalesce(F.lpad(number.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit(NO_ID)))


class Files:
    """Opens files of the shared folder, by URI or path, on any file system; keeps a few open for range reads."""

    def __init__(self, kept: int = 32):
        self.kept = kept
        self.open: OrderedDict = OrderedDict()

    @staticmethod
    def place(uri: str) -> tuple:
        from pyarrow import fs

        if uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        return fs.FileSystem.from_uri(uri)

    def create(self, uri: str):
        system, path = self.place(uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return system.open_output_stream(path, compression=None)

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri not in self.open:
            system, path = self.place(uri)
            self.open[uri] = system.open_input_file(path)
            if len(self.open) > self.kept:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return self.open[uri].read_at(length, offset)


def gzip_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def record(kind: str, url: str | None, page_id: int | None, digest: str, payload: bytes, refers: tuple | None) -> bytes:
    """One WARC record; ``refers``: page_id and capture key of the response that a revisit names."""
    from urllib.parse import quote

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if refers:
        head[5:5] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers[0]}>",
            f"WARC-Refers-To-Capture: {quote(refers[1])}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def _number(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def with_types(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Rows with key, payload digest and length, and, for revisits, the response they refer to."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        "url",
        html.alias("html"),
        F.sha1(html).alias("digest"),
        F.octet_length(html).cast("bigint").alias("size"),
    )
    latest = (
        rows.where(F.col("size") >= min_bytes)
        .select("digest", "size", "page_id", capture_key(F.col("url"), F.col("page_id")).alias("key"))
        .groupBy("digest", "size")
        .agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "key"))).alias("of"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and of is not null")
        .select("digest", "size", "of")
    )
    revisit = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("of.page_id"))
    return rows.join(latest, ["digest", "size"], "left").select(
        "page_id",
        "url",
        capture_key(F.col("url"), F.col("page_id")).alias("key"),
        "digest",
        F.when(revisit, F.lit(None)).otherwise(F.col("html")).alias("html"),
        F.when(revisit, F.col("of.page_id")).alias("to_page"),
        F.when(revisit, F.col("of.key")).alias("to_key"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000, file_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per row below ``folder``; the capture rows, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, name, at = Files(), None, "", 0
        part = TaskContext.get().partitionId()
        for b in batches:
            captures = []
            for r in b.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, at = files.create(name), 0
                kind = "response" if r["to_key"] is None else "revisit"
                refers = None if r["to_key"] is None else (r["to_page"], r["to_key"])
                data = gzip_member(record(kind, r["url"], r["page_id"], r["digest"], (r["html"] or "").encode(), refers))
                out.write(data)
                captures.append({"page_id": r["page_id"], "key": r["key"], "file": name, "offset": at, "length": len(data), "record_type": kind})
                at += len(data)
            if captures:
                yield pa.RecordBatch.from_pylist(captures, schema)
        if out is not None:
            out.close()

    schema = pa.schema([("page_id", pa.int64()), ("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string())])
    return stored(with_types(pages, min_bytes).mapInArrow(run, CAPTURE), "warc-captures")


def _ranges(df: DataFrame) -> DataFrame:
    """Ranges of ``key``, as many as the session's shuffles have partitions: a row is small, its work is not."""
    return df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")


def write_index(captures: DataFrame, folder: str, block_lines: int = 512) -> DataFrame:
    """Write the shards below ``folder``; (first_key, last_key, shard, directory_bytes) per shard, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        name = f"{folder}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, at, lines, directory, last = None, 0, [], [], ""

        def close_block() -> None:
            nonlocal at, lines
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), LEVEL)
            out.write(data)
            directory.append([lines[0][0], at, len(data)])
            at += len(data)
            lines = []

        for b in batches:
            for r in b.to_pylist():
                out = out or files.create(f"{name}.blocks")
                lines.append([r["key"], r["file"], r["offset"], r["length"]])
                last = r["key"]
                if len(lines) == block_lines:
                    close_block()
        if out is None:
            return
        if lines:
            close_block()
        out.close()
        data = zlib.compress(json.dumps(directory).encode(), LEVEL)
        with files.create(f"{name}.directory") as f:
            f.write(data)
        row = {"first_key": directory[0][0], "last_key": last, "shard": name, "directory_bytes": len(data)}
        yield pa.RecordBatch.from_pylist([row])

    ordered = _ranges(captures).sortWithinPartitions("key")
    return stored(
        ordered.select("key", "file", "offset", "length").mapInArrow(
            run, "first_key string, last_key string, shard string, directory_bytes bigint"
        ),
        "warc-shards",
    )


class Index:
    """Lookup in the shards; holds a few directories, blocks and resolved responses at a time."""

    def __init__(self, shards: list[tuple]):
        self.shards = sorted(shards)
        self.first = [s[0] for s in self.shards]
        self.files = Files()
        self.held: OrderedDict = OrderedDict()

    def _get(self, key: tuple, make):
        if key not in self.held:
            self.held[key] = make()
            if len(self.held) > 64:
                self.held.popitem(last=False)
        self.held.move_to_end(key)
        return self.held[key]

    def _directory(self, shard: str, size: int) -> tuple[list, list]:
        rows = json.loads(zlib.decompress(self.files.read(f"{shard}.directory", 0, size)))
        return [r[0] for r in rows], rows

    def _block(self, shard: str, offset: int, length: int) -> tuple[list, list]:
        lines = zlib.decompress(self.files.read(f"{shard}.blocks", offset, length)).decode()
        rows = [json.loads(x) for x in lines.split("\n")]
        return [r[0] for r in rows], rows

    def captures(self, low: str, high: str) -> Iterator[list]:
        """Index lines with low <= key <= high."""
        for s in range(max(0, bisect_left(self.first, low) - 1), bisect_right(self.first, high)):
            _, last, shard, size = self.shards[s]
            if last < low:
                continue
            firsts, blocks = self._get((shard,), lambda: self._directory(shard, size))
            for k in range(max(0, bisect_left(firsts, low) - 1), bisect_right(firsts, high)):
                _, offset, length = blocks[k]
                keys, rows = self._get((shard, offset), lambda: self._block(shard, offset, length))
                yield from rows[bisect_left(keys, low) : bisect_right(keys, high)]

    def records(self, low: str, high: str) -> Iterator[tuple[dict, bytes]]:
        for _, file, offset, length in self.captures(low, high):
            yield parse(zlib.decompress(self.files.read(file, offset, length), 31))

    def response(self, key: str, digest: str) -> tuple[int, str]:
        """Length and SHA-1 of the payload of the response stored under a key with a payload digest.

        A key may hold several captures (rows that share page_id and URL): the digest tells them apart.
        """

        def find() -> tuple[int, str]:
            for fields, payload in self.records(key, key):
                if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] == digest:
                    return len(payload), hashlib.sha1(payload).hexdigest()
            raise LookupError(f"no response with {digest} under {key!r}")

        return self._get(("response", key, digest), find)


def lookup(requests: DataFrame, shards: DataFrame) -> DataFrame:
    """Captures of each ``key`` of ``requests``: a full capture key, or an address (all its captures).

    page_id, payload_bytes, payload_digest, record_type, refers_to; length and
    digest are those of the payload read, for a revisit of the response's.
    """
    listed = [tuple(r) for r in shards.collect()]  # one row per index partition
    shared = requests.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote

        index = Index(shared.value)
        for b in batches:
            out = []
            for key in b.column("key").to_pylist():
                whole = " " in key
                for fields, payload in index.records(key if whole else key + " ", key if whole else key + " ~"):
                    refers = None
                    if fields["WARC-Type"] == "response":
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    else:
                        refers = _number(fields["WARC-Refers-To"])
                        size, digest = index.response(
                            unquote(fields["WARC-Refers-To-Capture"]), fields["WARC-Payload-Digest"]
                        )
                    if f"sha1:{digest}" != fields["WARC-Payload-Digest"]:
                        raise ValueError(f"damaged record under {key!r}")
                    out.append(
                        {
                            "page_id": _number(fields["WARC-Record-ID"]),
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": fields["WARC-Type"],
                            "refers_to": refers,
                        }
                    )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    ordered = _ranges(requests.select("key").distinct()).sortWithinPartitions("key")
    return ordered.mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def archive(spark: SparkSession, pages: DataFrame, min_bytes: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Write pages and index below the shared folder: (captures, shards)."""
    folder = state_path(spark, "warc")
    captures = write_archives(pages, f"{folder}/archives", min_bytes)
    return captures, write_index(captures, f"{folder}/index")
