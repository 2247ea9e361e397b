"""Deterministic sharded WARC writer, and its reader.

Pages are range-sorted by id: running sums of payload bytes over the ids, in a
Spark table, give shard borders that depend on the data alone. Each shard is one
partition; its task writes the records in id order as gzip
members and starts a new file when the next record would bring a file over
``roll_bytes`` compressed. Headers, lengths and digests are made anew; record
ids and dates depend on the record alone, so that equal input gives equal bytes.

Of records with equal payloads (of ``min_bytes`` or more) the one with the
smallest id is a response; the others are revisits that refer to it.

A task writes under a temporary name of its own attempt and returns manifest
rows. When all shards are written, the manifest's files get their final names
(which can be repeated), and last the manifest is written; readers open only
what it lists, so files of lost attempts are never read. Files are written and
read by pyarrow's file systems, in the shared folder.

Defined results: null html is an empty payload; rows that repeat an id keep
one record each, and those of the response's id are all responses; a null id
sorts first and is always a response; a null url is written as urn:none; an
empty table gives an empty manifest. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, file_system, prepare

SHARD_BYTES = 32 << 20  # of payload
ROLL_BYTES = 8 << 20  # of a compressed file
DATE = "2000-01-01T00:00:00Z"
READ = 1 << 20

MANIFEST = "name string, temporary string, shard int, records long, bytes long, sha256 string"
PAGES = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
         "url string, file string, payload binary")


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"] + [f"{k}: {v}".encode() for k, v in headers]
    lines.append(f"Content-Length: {len(block)}".encode())
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(b"\r\n".join(lines) + b"\r\n\r\n") + c.compress(block) + c.compress(b"\r\n\r\n") + c.flush()


def _name(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def page_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One gzip member: a response with its HTTP block, or a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    digest = _sha1(payload)
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:none")
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", _name("page", page_id, target, digest)), ("WARC-Date", DATE),
               ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
               ("WARC-Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        headers.append(("WARC-Page-ID", page_id))
    if revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To-Page-ID", refers_to)]
    return _record(headers, block)


class _Roller:
    """The files of one shard, under a temporary folder of this attempt."""

    def __init__(self, root: str, shard: int, roll: int):
        self.fs, self.root = file_system(root)
        self.attempt = f"_temporary/{uuid.uuid4().hex}"
        self.shard, self.roll, self.number, self.out = shard, roll, 0, None

    def add(self, member: bytes):
        if self.out is not None and self.size + len(member) > self.roll:
            yield self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.attempt}/{self.name}"
            self.fs.create_dir(f"{self.root}/{self.attempt}")
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temporary}")
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _name("file", self.name)),
                            ("WARC-Date", DATE), ("WARC-Filename", self.name),
                            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self._put(info)
        self._put(member)
        self.records += 1

    def _put(self, data: bytes):
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.out.close()
        self.out = None
        self.number += 1
        return {"name": self.name, "temporary": self.temporary, "shard": self.shard, "records": self.records,
                "bytes": self.size, "sha256": self.sha.hexdigest()}


_MANIFEST_ARROW = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int32()),
                             ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _writer(root: str, roll: int):
    def run(batches):
        roller = None
        for batch in batches:
            done = []
            for shard, page_id, refers_to, url, payload in zip(*(batch.column(i) for i in range(5))):
                shard = shard.as_py()
                if roller is None or roller.shard != shard:
                    if roller is not None:
                        done.append(roller.close())
                    roller = _Roller(root, shard, roll)
                done += roller.add(page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py()))
            if done:
                yield pa.RecordBatch.from_pylist(done, _MANIFEST_ARROW)
        if roller is not None:
            yield pa.RecordBatch.from_pylist([roller.close()], _MANIFEST_ARROW)
    return run


def _commit(root: str):
    def run(batches):
        fs, base = file_system(root)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, target = f"{base}/{temporary}", f"{base}/{name}"
                if fs.get_file_info(source).type != pafs.FileType.NotFound:
                    fs.move(source, target)
                elif fs.get_file_info(target).type == pafs.FileType.NotFound:
                    raise FileNotFoundError(temporary)
            yield batch
    return run


def read_members(stream):
    """The uncompressed gzip members of a stream, one at a time."""
    rest = b""
    while True:
        if not rest:
            rest = stream.read(READ)
            if not rest:
                return
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            if not rest:
                rest = stream.read(READ)
                if not rest:
                    raise EOFError("a record is cut short")
            parts.append(unzip.decompress(rest))
            rest = unzip.unused_data
        yield b"".join(parts)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


def _reader(root: str, payloads: bool):
    def run(batches):
        fs, base = file_system(root)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                            ("file", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}") as stream:
                    for member in read_members(stream):
                        h, block = parse_record(member)
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if f"sha1:{_sha1(block)}" != h["WARC-Block-Digest"] or \
                                h["WARC-Type"] == "response" and _sha1(payload) != digest:
                            raise ValueError(f"{name}: a record does not match its digest")
                        whole = h["WARC-Type"] == "response"
                        number = lambda k: int(h[k]) if k in h else None
                        rows.append({
                            "page_id": number("WARC-Page-ID"),
                            "payload_bytes": len(payload) if whole else number("WARC-Payload-Length"),
                            "payload_digest": digest, "record_type": h["WARC-Type"],
                            "refers_to": number("WARC-Refers-To-Page-ID"), "url": h["WARC-Target-URI"],
                            "file": name, "payload": payload if whole and payloads else None})
                        if len(rows) >= 256:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def shard_borders(scratch: Scratch, sized: DataFrame, shard_bytes: int) -> list[int]:
    """First ids of the shards after the first. sized has page_id and n (bytes).
    A shard begins at the first id before which a multiple of ``shard_bytes``
    lies that no id before has passed. Sums run inside ranges of ids and over
    the ranges; the driver sees one number for each shard."""
    ids = sized.where("page_id is not null").groupBy("page_id").agg(F.sum("n").alias("n"))
    ranged = scratch.table(ids.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "ranged")
    parts = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = parts.withColumn("base", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    inside = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(earlier, "part") \
        .select("page_id", F.expr(f"(base + before) div {int(shard_bytes)}").alias("shard"))
    firsts = before.groupBy("shard").agg(F.min("page_id").alias("first")).orderBy("first").collect()
    return [r["first"] for r in firsts[1:]]


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
                  roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archive under ``root`` and returns its manifest."""
    spark = prepare(pages.sparkSession)
    scratch = Scratch(spark, "warc")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
    sized = scratch.table(base.select("page_id", F.octet_length("payload").cast("long").alias("n"),
                                      F.sha1("payload").alias("digest")), "digests")
    twice = scratch.table(
        sized.where(F.col("n") >= min_bytes).groupBy("digest", "n")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last").select("digest", "first"), "repeated")
    borders = np.array(shard_borders(scratch, sized, shard_bytes), np.int64)
    spread = spark.sparkContext.broadcast(borders)  # eight bytes for each shard

    shard_of = F.pandas_udf(_shard_of(spread), "int")
    revisit = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    ready = base.withColumn("digest", F.sha1("payload")).join(twice, "digest", "left") \
        .select(shard_of("page_id").alias("shard"), "page_id", revisit.alias("refers_to"), "url", "payload", "digest")
    rows = ready.repartitionById(len(borders) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "url") \
        .select("shard", "page_id", "refers_to", "url", "payload")
    written = scratch.table(rows.mapInArrow(_writer(root, roll_bytes), MANIFEST), "written")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    done = written.repartition(width, "name").mapInArrow(_commit(root), MANIFEST).drop("temporary")
    done.write.parquet(f"{root}/manifest")
    return spark.read.schema(done.schema).parquet(f"{root}/manifest")


def _shard_of(spread):
    def shard_of(page_id: pd.Series) -> pd.Series:
        ids = page_id.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(spread.value, ids, side="right").astype("int32"))
    return shard_of


def read_archive(spark: SparkSession, root: str, payloads: bool = False) -> DataFrame:
    """The records of an archive, digests verified; payloads of responses on request."""
    manifest = prepare(spark).read.parquet(f"{root}/manifest").select("name")
    width = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return manifest.repartition(width, "name").mapInArrow(_reader(root, payloads), PAGES)


def round_trip(pages: DataFrame, root: str | None = None, **options) -> DataFrame:
    """Writes the pages and reads the archive back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    root = root or Scratch(prepare(spark), "archive").path("warc")
    write_archive(pages, root, **options)
    return read_archive(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: What the archive must hold, in DuckDB SQL (base32 spelled out from the digest's bits).
RECORDS_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, body, octet_length(encode(body)) AS n, min(page_id) OVER (PARTITION BY body) AS first,
             string_split(sha1(body), '') AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(hex, lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '')
             AS bits FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
         + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
         + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
         + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""
