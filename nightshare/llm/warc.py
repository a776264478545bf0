"""WARC archives with a two-level capture index: sorted compressed blocks below a sparse block directory."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightshare.llm.common import saved, shared_dir, store

LEAST, BLOCK_LINES, DATE, READ_AHEAD = 100, 1000, "2024-01-01T00:00:00Z", 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Reversed-host key: ``http://www.Example.org:80/a?b`` -> ``org,example,www)/a?b``; null gives an empty key."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"#.*$", ""), r"[\x00-\x20\x7f]", "")
    rest = F.regexp_replace(bare, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^([^/?]*)", 1), r"^.*@", ""), r":\d*$", ""))
    return F.when(rest == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(rest, r"^[^/?]*", "")))


def capture_key(page_id: Column) -> Column:
    return F.coalesce(F.lpad(F.hex(page_id.cast("long")), 16, "0"), F.lit("-"))


def record(kind: str, url: str | None, page_id: int | None, digest: str, html: bytes, refers_to: int | None) -> bytes:
    """One gzip member with one record; a revisit keeps the payload's headers and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    body = http + (html if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = lambda block: {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
    fields = named(head)
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    return fields, named(http), payload


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST) -> DataFrame:
    """Write one record per row below ``root``; returns the captures (key, capture, file, at, size).

    Equal payloads are found by digest: counts are combined before the shuffle, and the table of
    repeated digests is joined back, split where one payload holds many rows. A task writes one
    file under a name of its own attempt; only files named in the result count.
    """
    html = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html")).withColumn("digest", F.sha2("html", 256))
    repeated = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    repeated = saved(repeated.select(F.col("digest").alias("d"), "first"), "repeated")
    joined = rows.join(repeated, F.col("digest") == F.col("d"), "left").select("page_id", "url", "html", "digest", "first", url_key(F.col("url")).alias("key"), capture_key(F.col("page_id")).alias("capture"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        fs.create_dir(base, recursive=True)
        out, at, name = None, 0, f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            keys, captures, places, sizes = [], [], [], []
            for page_id, url, html, digest, first, key, capture in zip(*batch.columns, strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                page_id, first = page_id.as_py(), first.as_py()
                kind = "response" if first is None or page_id == first else "revisit"
                data = record(kind, url.as_py(), page_id, digest.as_py(), html.as_py(), first)
                out.write(data)
                keys.append(key.as_py())
                captures.append(capture.as_py())
                places.append(at)
                sizes.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(captures, pa.string()), pa.array([name] * len(keys)), pa.array(places, pa.int64()), pa.array(sizes, pa.int64())], names=["key", "capture", "file", "at", "size"])
        if out is not None:
            out.close()

    return saved(joined.mapInArrow(run, "key string, capture string, file string, at bigint, size bigint"), "captures")


# --- the index ---------------------------------------------------------------------------


def _line(*fields) -> bytes:
    return "\t".join(map(str, fields)).encode("utf-8", "surrogatepass")


def build_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort captures by key into files of compressed blocks, each with a directory of first keys; returns the shards.

    Range partitioning by (key, capture) keeps a busy host in many shards. The result has one row
    per shard: file, first and last entry.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        fs.create_dir(base, recursive=True)
        name = f"index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, at, block, directory, first, last = None, 0, [], [], None, None

        def flush() -> None:
            nonlocal at, block
            data = zlib.compress(b"\n".join(_line(*x) for x in block), 6)
            out.write(data)
            directory.append(_line(block[0][0], block[0][1], at, len(data)))
            at, block = at + len(data), []

        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    out, first = fs.open_output_stream(f"{base}/{name}.blocks", compression=None), entry
                last = entry
                block.append(entry)
                if len(block) == block_lines:
                    flush()
        if out is not None:
            if block:
                flush()
            out.close()
            with fs.open_output_stream(f"{base}/{name}.directory", compression=None) as d:
                d.write(zlib.compress(b"\n".join(directory)))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (name, first[0], first[1], last[0], last[1])], names=["file", "first_key", "first_capture", "last_key", "last_capture"])

    ordered = captures.select("key", "capture", "file", "at", "size").repartitionByRange("key", "capture").sortWithinPartitions("key", "capture", "file", "at")
    return saved(ordered.mapInArrow(run, "file string, first_key string, first_capture string, last_key string, last_capture string"), "shards")


class IndexReader:
    """Looks keys up: shard by its range, block by binary search of the directory, then one range read."""

    def __init__(self, fs, base: str, shards: list[tuple], blocks_kept: int = 8, directories_kept: int = 4):
        self.fs, self.base = fs, base
        self.shards = sorted(shards, key=lambda s: s[1:3])
        self.lasts = [s[3:5] for s in self.shards]
        self.directories, self.blocks, self.kept = OrderedDict(), OrderedDict(), (directories_kept, blocks_kept)

    def _directory(self, name: str) -> tuple[list, list]:
        if name not in self.directories:
            with self.fs.open_input_file(f"{self.base}/{name}.directory") as f:
                rows = [x.decode("utf-8", "surrogatepass").split("\t") for x in zlib.decompress(f.read()).split(b"\n")]
            self.directories[name] = [(r[0].encode("utf-8", "surrogatepass"), r[1].encode()) for r in rows], [(int(r[2]), int(r[3])) for r in rows]
            if len(self.directories) > self.kept[0]:
                self.directories.popitem(last=False)
        return self.directories[name]

    def _block(self, name: str, at: int, size: int) -> tuple[list, list]:
        if (name, at) not in self.blocks:
            with self.fs.open_input_file(f"{self.base}/{name}.blocks") as f:
                f.seek(at)
                rows = [x.split(b"\t") for x in zlib.decompress(f.read(size)).split(b"\n")]
            self.blocks[name, at] = [(r[0], r[1]) for r in rows], [(r[2].decode(), int(r[3]), int(r[4])) for r in rows]
            if len(self.blocks) > self.kept[1]:
                self.blocks.popitem(last=False)
        return self.blocks[name, at]

    def find(self, key: str, capture: str | None = None) -> Iterator[tuple[str, str, int, int]]:
        """(capture, file, at, size) of a key's captures, or of one capture."""
        k = key.encode("utf-8", "surrogatepass")
        q = (k, (capture or "").encode())

        def past(entry: tuple[bytes, bytes]) -> bool:
            return entry[0] > k or capture is not None and entry > q

        for s in range(bisect_left(self.lasts, q), len(self.shards)):
            name = self.shards[s][0]
            if past(self.shards[s][1:3]):
                return
            firsts, places = self._directory(name)
            for b in range(max(0, bisect_left(firsts, q) - 1), len(firsts)):
                if past(firsts[b]):
                    return
                entries, records = self._block(name, *places[b])
                for e in range(bisect_left(entries, q), len(entries)):
                    if past(entries[e]):
                        return
                    yield entries[e][1].decode(), *records[e]


def lookup(spark: SparkSession, shards: DataFrame, root: str, queries: DataFrame) -> DataFrame:
    """``queries`` (key, capture; capture null: all captures of the key) -> key, capture, file, at, size.

    The shards' ranges (one row per index file) go to every task; directories and blocks are read
    by the tasks that need them. Queries are sorted first, so a block is read once.
    """
    enc = lambda s: s.encode("utf-8", "surrogatepass")
    ranges = spark.sparkContext.broadcast([(r[0], *map(enc, r[1:])) for r in shards.collect()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        reader = IndexReader(fs, base, ranges.value)
        for batch in batches:
            out = [(key, *hit) for key, capture in zip(*(c.to_pylist() for c in batch.columns), strict=True) for hit in reader.find(key, capture)]
            if out:
                cols = [*zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), *(pa.array(c, pa.int64()) for c in cols[3:])], names=["key", "capture", "file", "at", "size"])

    asked = queries.select("key", "capture").distinct().repartitionByRange("key", "capture").sortWithinPartitions("key", "capture")
    return asked.mapInArrow(run, "key string, capture string, file string, at bigint, size bigint")


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each capture, by range reads in file order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        name, file, start, held = None, None, 0, b""
        for batch in batches:
            out = []
            for path, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != name:
                    name, file, held = path, fs.open_input_file(f"{base}/{path}"), b""
                if not start <= at or at + size > start + len(held):  # neighbours come with one read
                    file.seek(at)
                    start, held = at, file.read(max(size, READ_AHEAD))
                fields, http, payload = parse(held[at - start : at - start + size])
                page = fields["warc-record-id"].removeprefix("<urn:page:").rstrip(">")
                page_id = None if page == "none" else int(page)
                if fields["warc-type"] == "response":
                    out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "response", None))
                else:
                    out.append((page_id, int(http["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:"), "revisit", int(fields["warc-refers-to"].removeprefix("<urn:page:").rstrip(">"))))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    ordered = captures.select("file", "at", "size").repartitionByRange("file", "at").sortWithinPartitions("file", "at")
    return ordered.mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives and index, look every page's capture up in the index and read its record.

    Null html is an empty payload; payloads under ``least`` bytes are all responses; rows that repeat
    the smallest page_id of a payload are responses too, and rows with null page_id revisit it. A null
    url has an empty key and no target header. Repeated rows give repeated records. Other columns
    are ignored; an empty table gives no record.
    """
    spark = pages.sparkSession
    root = shared_dir(spark, "warc")
    shards = build_index(write_archive(pages, root, id_col, url_col, html_col, least), root, block_lines)
    queries = pages.select(url_key(F.col(url_col)).alias("key"), capture_key(F.col(id_col)).alias("capture"))
    return read_records(lookup(spark, shards, root, queries), root)
