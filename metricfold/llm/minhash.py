"""MinHash near-dedup by fast similarity sketching.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. The
sketch has ``bins`` coordinates. In round i every element is hashed to one bin
and a value; a bin keeps the least value of the first round that reaches it.
From round ``bins`` on, round i sends every element to bin i - bins, so all
coordinates fill at last. The share of equal coordinates concentrates around
the Jaccard similarity. Four coordinates make a band; documents that share a
band are candidates, and candidates are confirmed on full sets.

Equal sets form one class first. In a band, the class with the smallest id is
compared with every other (a star, not all pairs); classes joined so far are
one component, and only pairs of different components that still share a band
are compared afterwards. That loses no link that the bands find and keeps
large groups of near copies linear.

Defined results: null, empty or blank text has an empty set and is linked with
nothing; a text of fewer than five words is one shingle; rows that share an id
are one node of the graph; a row whose id is null stays as it is (component
null, kept). Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import GOLD, Scratch, bounded, components, mix, prepare, word_hashes

SHINGLE = 5
BINS = 128
ROWS = 4  # coordinates a band: at similarity 0.75, 32 bands miss 5 in a million
RARE = 8  # sets that hold an element at most, for it to count as rare
MIN_SHARE = 0.5  # of equal coordinates, 6.5 deviations below 0.75
BIN_BITS = 7  # of BINS
VALUE_BITS = 49  # between them, eight bits for the round
BIN_MASK = np.uint64(((1 << BIN_BITS) - 1) << (64 - BIN_BITS))
VALUE_MASK = np.uint64((1 << VALUE_BITS) - 1)
SECOND = np.arange(BINS + 1, 2 * BINS + 1, dtype=np.uint64) * GOLD
#: Odd multipliers that keep the order of a shingle's words.
PLACES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                   0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    n = max(1, len(w) - width + 1)
    k = min(width, len(w))
    acc = np.full(n, k, np.uint64)
    for i in range(k):
        acc += w[i:i + n] * PLACES[i]
    acc = mix(acc)
    acc.sort()
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(acc[1:], acc[:-1], out=new[1:])
    return acc[new]


def sketch(items: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The coordinate of each bin: the least (round, value) placed in it.

    Rounds are hashed together, as many as will likely fill the bins; bin,
    round and value share one 64-bit number, so that one sort finds each
    bin's first. The value differs by round and bin, and so do coordinates.
    """
    out = np.zeros(bins, np.uint64)
    full = np.zeros(bins, bool)
    done, width = 0, np.uint64(64 - BIN_BITS)
    while done < bins:
        some = min(bins - done, 1 + 8 * bins // len(items))
        rounds = np.arange(done, done + some, dtype=np.uint64)
        h = mix(items[None, :] + ((rounds + np.uint64(1)) * GOLD)[:, None])
        key = (h & BIN_MASK) | (rounds[:, None] << np.uint64(VALUE_BITS)) | (h & VALUE_MASK)
        key = key.ravel()
        key.sort()
        at = (key >> width).astype(np.int64)
        first = np.empty(len(at), bool)
        first[0] = True
        np.not_equal(at[1:], at[:-1], out=first[1:])
        at, key = at[first], key[first]
        new = ~full[at]
        out[at[new]] = key[new]
        full[at] = True
        done += some
        if full.all():
            return out
    for b in np.flatnonzero(~full):  # rounds bins..2*bins: everything goes to one bin
        h = mix(items + SECOND[b])
        out[b] = (h & VALUE_MASK).min() | np.uint64(int(b) << (64 - BIN_BITS))
    return out


def bands(coords: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key for each band of ``rows`` coordinates."""
    grid = coords.reshape(-1, rows)
    acc = np.arange(1, len(grid) + 1, dtype=np.uint64) * GOLD
    for j in range(rows):
        acc = mix(acc + grid[:, j] * PLACES[j])
    return acc


def _features(batches):
    for batch in batches:
        out = {k: [] for k in ("doc_id", "n_shingles", "d1", "d2", "bands", "sketch")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            items = shingles(text.as_py())
            out["doc_id"].append(doc_id)
            out["n_shingles"].append(len(items))
            if len(items):
                place = np.arange(1, len(items) + 1, dtype=np.uint64)
                d = [int(mix(items + place * p).sum(dtype=np.uint64).view(np.int64)) for p in PLACES[:2]]
                coords = sketch(items)
                out["bands"].append(bands(coords).view(np.int64))
                out["sketch"].append((coords & np.uint64(0xFFFF)).astype("<u2").tobytes())
            else:
                d = [None, None]
                out["bands"].append(None)
                out["sketch"].append(None)
            out["d1"].append(d[0])
            out["d2"].append(d[1])
        yield pa.RecordBatch.from_arrays([
            pa.array(out["doc_id"], pa.int64()), pa.array(out["n_shingles"], pa.int64()),
            pa.array(out["d1"], pa.int64()), pa.array(out["d2"], pa.int64()),
            pa.array(out["bands"], pa.list_(pa.int64())), pa.array(out["sketch"], pa.binary())],
            names=list(out))


def _sets(batches):
    for batch in batches:
        sets = [shingles(t.as_py()).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "items"])


def _alike(batches):
    """Pairs whose sketches agree in enough coordinates to be worth a check."""
    for batch in batches:
        keep = [np.count_nonzero(np.frombuffer(x.as_py(), "<u2") == np.frombuffer(y.as_py(), "<u2"))
                >= MIN_SHARE * BINS for x, y in zip(batch.column(2), batch.column(3))]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _confirm(threshold: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept. See the
    module text for the method and the defined results."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "minhash")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("binary").alias("text"))
    feats = scratch.table(texts.mapInArrow(
        _features, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary"),
        "features")
    # Equal sets are one class, represented by its smallest id.
    known = feats.where("d1 is not null and doc_id is not null")
    classes = scratch.table(known.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    member = known.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]).select("doc_id", "rep")
    reps = scratch.table(
        known.join(classes.select("d1", "d2", F.col("rep").alias("doc_id")), ["d1", "d2", "doc_id"])
        .select(F.col("doc_id").alias("id"), "d1", "bands", "sketch")
        .dropDuplicates(["id", "d1"]), "reps")
    keys = reps.select("id", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")) \
        .where("lead < last").select("key", "lead")
    shared = scratch.table(keys.join(crowded, "key"), "shared")

    # The full sets of all that share a band, from one more pass over the texts.
    able = bounded(scratch.table(shared.select(F.col("id").alias("doc_id")).distinct(), "able"))
    sets = scratch.table(texts.join(able, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text")
                         .mapInArrow(_sets, "id long, items array<long>"), "sets")

    star = shared.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = _verified(scratch, star, reps, sets, percent)
    roots = components(scratch, links)
    # What still shares a band across components. An element held by few sets
    # (RARE) is paired directly, which is linear; sets that share no such
    # element can only meet in their other elements. 100 * both >= percent *
    # union then bounds the sizes, and most pairs fall without being compared.
    root = roots.select(F.col("node").alias("id"), "component")
    rooted = shared.join(root, "id", "left") \
        .select("key", "id", F.coalesce("component", "id").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")) \
        .where("x < y").select("key")
    left = scratch.table(rooted.join(mixed, "key"), "left")
    items = scratch.table(sets.join(left.select("id").distinct(), "id", "left_semi")
                          .select("id", F.explode("items").alias("item")).distinct(), "elements")
    held = items.groupBy("item").agg(F.count("*").alias("held")).where(F.col("held") <= RARE)
    rare = scratch.table(items.join(held, "item"), "rare")
    sizes = items.groupBy("id").agg(F.count("*").alias("size")).join(
        rare.groupBy("id").agg(F.count("*").alias("rare"), F.expr("count_if(held = 1)").alias("alone")),
        "id", "left").select("id", "size",
                             (F.col("size") - F.coalesce("alone", F.lit(0))).alias("most"),
                             (F.col("size") - F.coalesce("rare", F.lit(0))).alias("rest"))
    nodes = scratch.table(
        left.groupBy("id", "root").agg(F.collect_set("key").alias("keys")).join(sizes, "id")
        .where(f"100 * most >= {percent} * size"), "nodes")
    fits = f"(100 + {percent}) * least(%s, y.%s) >= {percent} * (x.size + y.size)"
    groups = left.select("key", "id").join(nodes, "id")
    # A pair that shares several bands is made in the first one only.
    by_band = groups.alias("x").join(groups.alias("y"), "key").where(
        "x.root <> y.root and x.id < y.id and " + fits % ("x.rest", "rest")
        + " and key = array_min(array_intersect(x.keys, y.keys))")
    few = rare.where("held > 1").select("item", "id").join(nodes.drop("keys"), "id")
    by_item = few.alias("x").join(few.alias("y"), "item").where(
        "x.root <> y.root and x.id < y.id and " + fits % ("x.most", "most"))
    pair = [F.col("x.id").alias("a"), F.col("y.id").alias("b")]
    cross = by_band.select(*pair).unionAll(by_item.select(*pair)).distinct()
    more = _verified(scratch, cross, reps, sets, percent)
    same_id = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")) \
        .where("a <> b").select("a", "b")
    roots = components(scratch, links.unionAll(more).unionAll(same_id))
    owner = member.groupBy("doc_id").agg(F.min("rep").alias("node")) \
        .join(roots, "node", "left") \
        .select("doc_id", F.coalesce("component", "node").alias("component_id"))
    return feats.select("doc_id", "n_shingles").join(owner, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _verified(scratch: Scratch, pairs: DataFrame, reps: DataFrame, sets: DataFrame,
              percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    s = reps.select("id", "sketch")
    likely = scratch.table(
        pairs.join(s.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(s.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
        .select("a", "b", "sa", "sb").mapInArrow(_alike, "a long, b long"), "likely").distinct()
    full = likely.join(sets.select(F.col("id").alias("a"), F.col("items").alias("ia")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("items").alias("ib")), "b") \
        .select("a", "b", "ia", "ib").mapInArrow(_confirm(percent), "a long, b long")
    return scratch.table(full, "links")


#: The contract's result in DuckDB SQL, by joining the shingles themselves.
COMPONENTS_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
      FROM w, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS t(i) WHERE len(ws) > 0),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * met >= 75 * (x.n + y.n - met)),
r AS (SELECT doc_id AS n, doc_id AS m FROM documents UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.n),
c AS (SELECT n, min(m) AS component_id FROM r GROUP BY n)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.n = d.doc_id LEFT JOIN z ON z.doc_id = d.doc_id
"""
