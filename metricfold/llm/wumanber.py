"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of 13 consecutive words of the benchmark items
(an item of fewer words, but not none, is one pattern). Patterns of one length
m share a table: a block is two neighbouring words (one where m is 1); the
shift table gives, for the block that ends at a position, how far the search
can move without missing a match; a shift of 0 leads to the bucket of patterns
that end in that block, and a direct comparison confirms each.

Benchmark items reach the tasks as broadcast tables of at most BLOCK_WORDS
item words each; a larger benchmark is searched for block by block, and the
blocks' hits meet per document. Documents are searched whole, row by row.

Defined results: null text has no words; words are runs of a-z (A-Z
lower-cased), 0-9 and characters beyond ASCII; items with equal ids count
once; an item with null id or without words has no window; a repeated
document row gives a repeated result row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

WINDOW = 13
#: Words of benchmark items in one broadcast table (some 100 MB in a task).
BLOCK_WORDS = 1_000_000
#: Contaminated from 1 hit word in this many.
SHARE = 20

_WORD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


class Patterns:
    """Shift and bucket tables of the patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple, set]):
        self.length = length
        self.width = min(2, length)
        self.far = length - self.width + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, list] = defaultdict(list)
        for words, items in patterns.items():
            for end in range(self.width, length + 1):
                block = words[end - self.width:end]
                away = length - end
                if away < self.shift.get(block, self.far):
                    self.shift[block] = away
            self.buckets[words[length - self.width:]].append((words, items))

    def search(self, words: list[bytes]):
        """(start, items) of every occurrence."""
        m, shift, far, buckets = self.length, self.shift.get, self.far, self.buckets
        at, n = m, len(words)
        if self.width == 1:
            while at <= n:
                block = (words[at - 1],)
                for _, items in buckets.get(block, ()):
                    yield at - 1, items
                at += 1
            return
        while at <= n:
            block = (words[at - 2], words[at - 1])
            step = shift(block, far)
            if step:
                at += step
                continue
            found = tuple(words[at - m:at])
            for pattern, items in buckets[block]:
                if pattern == found:
                    yield at - m, items
            at += 1


def build(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Patterns]:
    """Tables for the windows of (item id, text) pairs, one for each length."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for at in range(len(words) - m + 1 if m else 0):
            by_length[m][tuple(words[at:at + m])].add(item)
    return [Patterns(m, patterns) for m, patterns in sorted(by_length.items())]


def _spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search(tables):
    def run(batches):
        matchers = tables.value
        for batch in batches:
            n_words, spans, items = [], [], []
            for text in batch.column(batch.num_columns - 1):
                words = words_of(text.as_py())
                hits, names = [], set()
                for table in matchers:
                    for at, found in table.search(words):
                        hits.append((at, at + table.length))
                        names |= found
                n_words.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in _spans(hits)])
                items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array(items, pa.list_(pa.string()))],
                names=["row", "n_words", "spans", "items"])
    return run


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row: doc_id, n_words, spans (array of word
    intervals [start, end) inside occurrences, merged and in order) and items
    (sorted ids, as strings, of the items with an occurring window)."""
    spark = prepare(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.col(item_text_col).cast("binary").alias("text")) \
        .where("item is not null and text is not null")
    # Blocks of items by a hash, as many as their total length asks for.
    letters = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + letters // (4 * block_words)
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("binary").alias("text"))
    schema = (f"row {docs.schema[id_col].dataType.simpleString()}, n_words long, "
              "spans array<struct<start:long,end:long>>, items array<string>")
    if blocks > 1:  # a key for each row, so that the blocks' hits of a row meet
        scratch = Scratch(spark, "wumanber")
        rows = scratch.table(rows.select(F.struct(F.monotonically_increasing_id().alias("n"),
                                                  F.col("row")).alias("row"), "text"), "rows")
        schema = schema.replace("row ", "row struct<n:long,row:", 1).replace(", n_words", ">, n_words", 1)
    parts = []
    for b in range(blocks):
        own = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        tables = spark.sparkContext.broadcast(
            build([(r["item"], bytes(r["text"])) for r in own.collect()], window))
        parts.append(rows.mapInArrow(_search(tables), schema))
    if blocks == 1:
        return parts[0].withColumnRenamed("row", id_col)
    for i, part in enumerate(parts):
        parts[i] = scratch.table(part, f"block-{i}")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    # Few rows a document (one for each block): merge their spans in order.
    merged = every.groupBy("row").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    join = F.aggregate(
        "spans", F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.try_element_at(acc, F.lit(-1))["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
                F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    return merged.select(F.col("row.row").alias(id_col), "n_words", join.alias("spans"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = SHARE, **options) -> DataFrame:
    """``find_items`` in figures: doc_id, n_words, n_hit (words inside any
    occurrence), n_items, items_sha256 (of the sorted ids, comma-joined) and
    contaminated (n_hit > 0 and share * n_hit >= n_words)."""
    id_col = options.get("id_col", "doc_id")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    found = find_items(docs, benchmark, **options).withColumn("n_hit", hit)
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

#: The contract's figures in DuckDB SQL: windows joined as lists of words.
CONTAMINATION_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
p AS (SELECT DISTINCT item, least(len(ws), 13) AS m,
             array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS win
      FROM b, unnest(generate_series(1, len(ws) - least(len(ws), 13) + 1)) AS t(i) WHERE len(ws) > 0),
ms AS (SELECT DISTINCT m FROM p),
h AS (SELECT doc_id, i, ms.m, array_to_string(ws[i:i + ms.m - 1], ' ') AS win
      FROM w, ms, unnest(generate_series(1, len(ws) - ms.m + 1)) AS t(i)),
o AS (SELECT DISTINCT h.doc_id, h.i, h.m, p.item FROM h JOIN p ON h.m = p.m AND h.win = p.win),
n AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT DISTINCT doc_id, i, m FROM o), unnest(generate_series(i, i + m - 1)) AS t(k)
      GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
      FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""
