"""Shared pieces: scratch tables in the shared folder, word hashing and
connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricfold.session import checkpoint_root, tune

#: Rows per Arrow batch handed to Python, so that a batch of texts stays small.
ARROW_ROWS = 512

MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
GOLD = np.uint64(0x9E3779B97F4A7C15)
S33 = np.uint64(33)


#: Spark's setting that drops the shuffle files of a query when it ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Ids that a task may hold as a broadcast set (16 bytes each or so).
BROADCAST_IDS = 1_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults, with small Arrow batches and small measured
    broadcasts where the session sets none."""
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, "4m")
    tune(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


class Scratch:
    """Tables of one run in the cluster's shared folder. They cut lineage and
    survive lost executors; superseded ones can be dropped. With ``tidy`` the
    shuffle files that a table was made from go as soon as it is written, not
    when the driver next collects garbage."""

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.root = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        tidied = self.spark.conf.get(TIDY, None)
        try:
            if self.tidy and tidied is None:
                self.spark.conf.set(TIDY, "true")
            df.write.parquet(path)
        finally:
            if self.tidy and tidied is None:
                self.spark.conf.unset(TIDY)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            p = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            p.getFileSystem(conf).delete(p, True)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system for a path as Spark spells it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def bounded(ids: DataFrame) -> DataFrame:
    """A table of ids, marked for broadcast if it holds BROADCAST_IDS or fewer.
    A larger one is joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, ignoring case."""
    used, name = {c.lower() for c in df.columns}, base
    while name.lower() in used:
        name = f"_{name}"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), element by element."""
    x = x ^ (x >> S33)
    x = x * MIX1
    x = x ^ (x >> S33)
    x = x * MIX2
    return x ^ (x >> S33)


# Random 64-bit value of each byte, equal for A-Z and a-z, from a fixed seed.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers[i] = np.multiply.accumulate(t)
    return _powers[0], _powers[1]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words between ASCII spaces."""
    space = np.empty(len(text) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


#: Bytes hashed at a time, so that a very long text needs little memory.
HASH_BLOCK = 1 << 20


def word_hashes(text: bytes | None, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """64-bit hashes of the words of a text (bytes between ASCII spaces), with
    A-Z as a-z: a polynomial over random byte values, by prefix sums. spans: its
    ``word_spans``, if they are known."""
    if not text:
        return np.empty(0, np.uint64)
    if len(text) > HASH_BLOCK:
        parts, at = [], 0
        while at < len(text):
            end = at + HASH_BLOCK
            while end < len(text) and not _SPACE[text[end]]:
                end += 1
            parts.append(_hash_block(text[at:end]))
            at = end
        return np.concatenate(parts)
    return _hash_words(text, *(spans or word_spans(text)))


#: Bytes of small texts hashed together.
JOINED = 60_000


def blocks_of(texts):
    """Lists of the texts in turn (null: empty), JOINED bytes at most together or one text."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > JOINED:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def hashes_of(texts):
    """``word_hashes`` of each text in turn; small ones are joined by a space and hashed
    at once."""
    for held in blocks_of(texts):
        yield from _hash_joined(held)


def _hash_joined(texts: list[bytes]):
    if len(texts) == 1:
        yield word_hashes(texts[0])
        return
    whole = b" ".join(texts)
    start, end = word_spans(whole)
    h, a = _hash_words(whole, start, end), 0
    for b in np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts])):
        yield h[a:b]
        a = b


def _hash_block(text: bytes) -> np.ndarray:
    return _hash_words(text, *word_spans(text))


def _hash_words(text: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(text) + 1)
    total = np.zeros(len(text) + 1, np.uint64)
    terms = np.take(_BYTE, np.frombuffer(text, np.uint8))
    terms *= up[:len(text)]
    np.cumsum(terms, out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of the graph with ``edges`` (a, b): one row
    (node, component) for every node that has an edge to another node, where
    component is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows those
    pointers to their roots by joins, and contracts the edges to the roots,
    which at least halves the nodes left. Smallest neighbours are partial
    aggregates, so a hub with a third of all edges is reduced before the
    shuffle. Every step is a table in the shared folder; the driver sees only
    counts.
    """
    spark = scratch.spark
    e = scratch.table(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "edges")
    levels = []
    while not e.isEmpty():
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        p = scratch.table(both.groupBy("u").agg(F.min("v").alias("v"))
                          .select("u", F.least("u", "v").alias("p")), "parents")
        while True:
            up = p.select(F.col("u").alias("p"), F.col("p").alias("g"))
            q = scratch.table(
                p.join(up, "p", "left").select("u", F.coalesce("g", "p").alias("p"),
                                               (F.col("g") < F.col("p")).alias("moved")), "jump")
            scratch.drop(p)
            p = q
            if p.where("moved").isEmpty():
                break
            p_next = p.select("u", "p")
            p_next._scratch_path = p._scratch_path
            p = p_next
        levels.append(p)
        pa = p.select(F.col("u").alias("a"), F.col("p").alias("ra"))
        pb = p.select(F.col("u").alias("b"), F.col("p").alias("rb"))
        e2 = scratch.table(
            e.join(pa, "a").join(pb, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            "edges")
        scratch.drop(e)
        e = e2
    kind = e.schema["a"].dataType
    if not levels:
        return spark.createDataFrame([], f"node {kind.simpleString()}, component {kind.simpleString()}")
    out = levels[0].select(F.col("u").alias("node"), F.col("p").alias("component"))
    for p in levels[1:]:
        up = p.select(F.col("u").alias("component"), F.col("p").alias("root"))
        out = out.join(up, "component", "left").select(
            "node", F.coalesce("root", "component").alias("component"))
    return scratch.table(out, "components")
