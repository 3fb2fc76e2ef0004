"""Deterministic sharded WARC archives: range-sorted records, rolled files, manifest commit.

Writing, as Spark jobs:

1. Payload digests are computed in SQL.  Of records with equal payloads of ``MIN_REVISIT``
   bytes or more, that with the largest id becomes the response and the others revisit it.
   Only ids and digests are joined (Spark splits that join where one payload is hot).
2. Records, and before each revisit its mark, are range-partitioned by (id, digest) and
   sorted, so payloads are shuffled once.  Every task writes its
   range, one gzip member per record, and starts a new file once the compressed size
   passes ``ROLL_BYTES``.  Headers, digests and record ids are regenerated from the record
   alone and gzip members carry no time stamp, so a rerun writes the same bytes.
3. Files appear under temporary names (one per task attempt).  The rows that Spark accepts
   from the task attempts form the manifest; a second job renames exactly those files,
   and does nothing for a file that is already in place.  The manifest is written last:
   without it the archive does not exist, and what lost attempts left behind is never read.

Reading starts from the manifest, checks every file's SHA-256, block and payload digest,
and returns one row per record.

Files are written and read through ``pyarrow.fs`` on the folder's URI, so the folder must
be one that every executor reaches (``shared_dir``).

Null text is an empty payload.  Null ids sort first, never become the original where an id
exists, and come back as null; null urls come back as null.  Rows that repeat the largest
id of a payload are responses all.  An empty table gives a manifest without files.  Further
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_dir

MIN_REVISIT = 1000
ROLL_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
STEP = 16 << 10
CRAWL_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard int, seq int, temp string, file string, records long, bytes long, sha256 string"
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("payload", T.StringType())])


# ---- records -------------------------------------------------------------------------------------------------------

def record_id(page_id, digest_hex: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest_hex}')}>"


def _sha1(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member with an empty time stamp
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def encode(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member; ``refers_to`` is the original's id for a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
               ("WARC-Date", CRAWL_DATE), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
               ("WARC-Block-Digest", _sha1(block)), ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~-._%")))
        if headers[-1][1] != url:
            headers.append(("X-Original-URI", base64.b64encode(url.encode()).decode()))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                    ("X-Refers-To-Page", str(refers_to))]
    return _member(headers, block)


def decode(raw: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of every record of an archive file."""
    at, view = 0, memoryview(raw)
    while at < len(raw):
        unpacker, parts, upto = zlib.decompressobj(31), [], at
        while not unpacker.eof:
            if upto >= len(raw):
                raise ValueError("the archive file ends inside a record")
            parts.append(unpacker.decompress(view[upto:upto + STEP]))
            upto += STEP
        used = min(upto, len(raw)) - len(unpacker.unused_data) - at
        data = b"".join(parts)
        head, _, rest = data.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield at, headers, rest[:int(headers["Content-Length"])]
        at += used


# ---- writing -------------------------------------------------------------------------------------------------------

def _fs(uri: str):
    return pafs.FileSystem.from_uri(uri)


class _Roller:
    """Collects records of one shard and writes a file whenever the compressed size passes the limit."""

    def __init__(self, root: str, shard: int, attempt: str, roll: int):
        self.fs, self.base = _fs(root)
        self.shard, self.attempt, self.roll, self.seq = shard, attempt, roll, 0
        self.buffer, self.records = io.BytesIO(), 0

    def add(self, member: bytes) -> list[tuple]:
        if not self.records:
            self.buffer.write(_member([("WARC-Type", "warcinfo"), ("WARC-Date", CRAWL_DATE),
                                       ("WARC-Record-ID", record_id(f"file:{self.shard}:{self.seq}", "")),
                                       ("Content-Type", "application/warc-fields")],
                                      b"format: WARC File Format 1.1\r\n"))
        self.buffer.write(member)
        self.records += 1
        return self.close() if self.buffer.tell() >= self.roll else []

    def close(self) -> list[tuple]:
        if not self.records:
            return []
        raw = self.buffer.getvalue()
        name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
        temp = f"_temporary-{name}.{self.attempt}"
        with self.fs.open_output_stream(f"{self.base}/{temp}", compression=None) as out:
            out.write(raw)
        row = (self.shard, self.seq, temp, name, self.records, len(raw), hashlib.sha256(raw).hexdigest())
        self.buffer, self.records, self.seq = io.BytesIO(), 0, self.seq + 1
        return [row]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(types)], names=names)


_MANIFEST_NAMES = [x.split()[0] for x in MANIFEST.split(", ")]
_MANIFEST_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _keyed(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html).alias("digest"), F.octet_length(html).alias("size"))


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit another."""
    keyed = _keyed(pages).where(F.col("size") >= min_bytes).select("page_id", "digest")
    copies = keyed.groupBy(F.col("digest").alias("of")).agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").drop("n")
    met = keyed.join(copies, F.col("digest") == F.col("of"))
    return met.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archive(pages: DataFrame, root: str, min_bytes: int = MIN_REVISIT, roll_bytes: int = ROLL_BYTES,
                  shard_bytes: int = SHARD_BYTES) -> None:
    """Writes (page_id, url, html) as WARC files and a manifest below ``root`` (a URI or path shared by all executors)."""
    spark = pages.sparkSession
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    fs, base = _fs(root)
    fs.create_dir(base, recursive=True)
    shards = int(total // shard_bytes) + 1
    # a mark travels with its page and sorts before it, so payloads are moved once
    marks = revisits(pages, min_bytes).select(
        "page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"), "refers_to")
    records = _keyed(pages).select("page_id", "digest", F.lit(1).alias("kind"), "url", "html",
                                   F.lit(None).cast("long").alias("refers_to"))
    ranged = records.unionByName(marks).repartitionByRange(shards, "page_id", "digest").sortWithinPartitions(
        "page_id", "digest", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        out = _Roller(root, task.partitionId(), f"{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}", roll_bytes)
        mark = None
        for batch in batches:
            rows = []
            for page_id, digest, kind, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 0:
                    mark = (page_id, digest, refers)
                else:
                    original = mark[2] if mark is not None and mark[:2] == (page_id, digest) else None
                    rows += out.add(encode(page_id, url, html.encode(), digest, original))
            yield _batch(rows, _MANIFEST_NAMES, _MANIFEST_TYPES)
        yield _batch(out.close(), _MANIFEST_NAMES, _MANIFEST_TYPES)

    accepted = fresh_dir(spark, "warc-accepted")
    ranged.mapInArrow(write, MANIFEST).write.parquet(accepted)

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(root)
        for batch in batches:
            for row in batch.to_pylist():
                final, temp = f"{base}/{row['file']}", f"{base}/{row['temp']}"
                if fs.get_file_info(final).type == pafs.FileType.NotFound:
                    fs.move(temp, final)
            yield batch

    listed = spark.read.parquet(accepted).mapInArrow(rename, MANIFEST)
    listed.drop("temp").write.parquet(f"{root.rstrip('/')}/manifest")


# ---- reading -------------------------------------------------------------------------------------------------------

def read_archive(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """One row per response or revisit record of a committed archive, digests verified."""
    manifest = spark.read.parquet(f"{root.rstrip('/')}/manifest").select("file", "sha256")
    n = manifest.count()
    names = [f.name for f in RECORD.fields if payloads or f.name != "payload"]
    schema = T.StructType([RECORD[x] for x in names])
    kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string()}
    types = [kinds[RECORD[x].dataType.simpleString()] for x in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(root)
        for batch in batches:
            for name, sha in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as f:
                    raw = f.read()
                if hashlib.sha256(raw).hexdigest() != sha:
                    raise ValueError(f"{name} differs from its manifest")
                rows = []
                for offset, headers, block in decode(raw):
                    if headers["WARC-Type"] != "warcinfo":
                        row = _record(name, offset, headers, block)
                        rows.append(row if payloads else row[:-1])
                        if len(rows) == 512:
                            yield _batch(rows, names, types)
                            rows = []
                yield _batch(rows, names, types)

    return manifest.repartition(max(1, n), "file").mapInArrow(read, schema)


def _record(name: str, offset: int, headers: dict[str, str], block: bytes) -> tuple:
    if _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"{name}:{offset}: block digest differs")
    payload = block.partition(b"\r\n\r\n")[2]
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and _sha1(payload) != headers["WARC-Payload-Digest"]:
        raise ValueError(f"{name}:{offset}: payload digest differs")
    digest = base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
    url = headers.get("WARC-Target-URI")
    if "X-Original-URI" in headers:
        url = base64.b64decode(headers["X-Original-URI"]).decode()
    page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
    size = int(headers["X-Payload-Length"]) if revisit else len(payload)
    return (page and int(page), url, size, digest, headers["WARC-Type"], refers and int(refers), name, offset,
            None if revisit else payload.decode())


def archive_report(pages: DataFrame) -> DataFrame:
    """Write all pages, read the archives back, one row per page."""
    spark = pages.sparkSession
    root = fresh_dir(spark, "warc")
    write_archive(pages.select("page_id", "url", "html"), root)
    return read_archive(spark, root, payloads=False).select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
