"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule lies at the golden-ratio point frac(i * 0.618...) of
the line [0, 1), on which every source owns an interval as long as its share of
the mix. So each source gets its share of any run of slots but for a few. A
slot takes one block of words, of one size for all sources (BLOCK, or fewer so
that a small mix has SLOTS slots or so). The slots of a source are ranked, and
slot k takes block k of the source: its documents, shuffled by a digest of
their id and read in that order (again from the start in a second epoch), cut
into blocks. What a source gives is what the points give it: its slots' blocks,
the last one cut at its target. The schedule runs on a little (SURPLUS) beyond the
blocks of the mix, so that sources which the points left short by a block or two
catch up; slots of a source that has its words are void. A source too small to
own a point gets one slot at the end.

Ranks and word offsets are two-level prefix sums (inside digest or slot
ranges, and over them), so that a source with a third of all rows is spread
over many tasks. Sources are matched with slots by cells of the line, an equi
join.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own, the last in order; rows that share id and source are
ordered among themselves by size and each counts; an empty table or one
without words gives targets of 0. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricfold.llm.common import Scratch, prepare

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
REPEATS = 2  # times a document is taken at most
BLOCK = 512  # words a slot takes
SLOTS = 1 << 14  # a mix has as many slots or so, if its words suffice
SURPLUS = 64  # the schedule is longer by one part in so many, and by 4
CELLS = 4096  # of the line, to match slots with sources
CHUNK = 4096  # slots ranked together
GOLDEN = (math.sqrt(5) - 1) / 2
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(scratch: Scratch, sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """source, source_size, weight, target. Targets share ``share`` of all
    words by weight; one above ``repeats`` times its source's size stops
    there, and the excess is shared by weight among the rest, until none is
    above. Each round is one aggregate over the sources (two sums)."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    t = scratch.table(
        by_source.withColumn("weight", F.get(cycle, F.pmod(place, F.lit(len(weights)))).cast("double"))
        .withColumn("cap", (repeats * F.col("source_size")).cast("double")), "sources")
    total = (t.agg(F.sum("source_size")).first()[0] or 0) * share
    level, stopped = None, -1
    while True:
        # With level None every source shares; then those whose part exceeds their cap stop.
        full = F.lit(False) if level is None else F.col("weight") * level > F.col("cap")
        row = t.agg(F.count_if(full), F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
                    F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if row[0] == stopped or not row[2]:
            break
        stopped, level = row[0], (total - row[1]) / row[2]
    if level is None:
        return t.select("source", "source_size", "weight", F.lit(0.0).alias("target"))
    part = F.col("weight") * F.lit(float(level))
    return t.select("source", "source_size", "weight",
                    F.when(part > F.col("cap"), F.col("cap")).otherwise(part).alias("target"))


def word_offsets(scratch: Scratch, sizes: DataFrame, seed: str) -> DataFrame:
    """Each document's interval [start, stop) of words in its source's shuffled order."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    at = sizes.where("size > 0").withColumn("digest", digest) \
        .withColumn("part", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"))
    at = scratch.table(at, "shuffled")
    parts = at.groupBy("source", "part").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("source", "part", F.coalesce(F.sum("words").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "part").orderBy("digest", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, 0)
    run = at.withColumn("run", F.sum("size").over(inside))
    same = (run["source"].eqNullSafe(before["source"])) & (run["part"] == before["part"])
    return run.join(before, same).select(
        "doc_id", run["source"], "size", (F.col("before") + F.col("run") - F.col("size")).alias("start"),
        (F.col("before") + F.col("run")).alias("stop"))


def ranked_slots(scratch: Scratch, targets: DataFrame, block: int, step: float = GOLDEN) -> DataFrame:
    """slot, source, rank (from 0 within the source), of as many slots as
    blocks make up the mix, with the surplus, and one more, at the end, for a
    source too small to own a point."""
    spark = scratch.spark
    live = targets.where("target > 0")
    total = live.agg(F.sum("target")).first()[0] or 0.0
    n = math.ceil(total / block) if total else 0
    n += n // SURPLUS + 4 if n else 0
    below = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    line = live.withColumn("low", F.coalesce(F.sum("target").over(below), F.lit(0.0)) / total) \
        .withColumn("high", F.lead("low").over(Window.orderBy(F.col("source").asc_nulls_last()))) \
        .withColumn("high", F.coalesce("high", F.lit(2.0))) if total else \
        live.withColumns({"low": F.lit(0.0), "high": F.lit(0.0)})
    line = scratch.table(line.select("source", "low", "high"), "line")
    cells = line.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)))))
    point = F.col("id") * F.lit(step) - F.floor(F.col("id") * F.lit(step))
    slots = spark.range(n).select(F.col("id").alias("slot"), point.alias("point")) \
        .withColumn("cell", F.floor(F.col("point") * CELLS))
    own = scratch.table(slots.join(cells, "cell").where("low <= point and point < high")
                        .select("slot", "source", (F.col("slot") / CHUNK).cast("long").alias("chunk")),
                        "slots")
    none = line.join(own.select(F.col("source").alias("s")).distinct(),
                     F.col("source").eqNullSafe(F.col("s")), "left_anti") \
        .select(F.lit(n).cast("long").alias("slot"), "source", F.lit(n // CHUNK + 1).cast("long").alias("chunk"))
    every = own.unionAll(none)
    chunks = every.groupBy("source", "chunk").agg(F.count("*").alias("n"))
    over = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select(F.col("source").alias("s"), F.col("chunk").alias("c"),
                           F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "chunk").orderBy("slot")
    return every.withColumn("i", F.row_number().over(inside) - 1) \
        .join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c"))) \
        .select("slot", "source", (F.col("before") + F.col("i")).alias("rank"))


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, block: int | None = None,
             step: float = GOLDEN, seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, takes). sizes has doc_id, source, size of every row;
    targets has source, source_size, weight, target; takes is the schedule: slot,
    source, doc_id, epoch and the words [from_word, to_word) of that document."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "mixing")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORDS)), F.lit(0)).cast("long")
    sizes = scratch.table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                      size.alias("size")), "sizes")
    targets = scratch.table(source_targets(scratch, sizes, weights, share, repeats), "targets")
    whole = targets.agg(F.sum("target")).first()[0] or 0.0
    block = block or max(1, min(BLOCK, math.floor(whole / SLOTS)))
    slots = scratch.table(ranked_slots(scratch, targets, block, step), "ranked")
    counts = slots.groupBy("source").agg(F.count("*").alias("blocks"))
    plan = scratch.table(
        targets.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .where("target >= 1")
        .select(F.col("source").alias("s"), F.col("source_size").alias("all"),
                F.least(F.floor("target"), F.col("blocks") * block).alias("quota")), "plan")
    spans = word_offsets(scratch, sizes, seed).join(plan, F.col("source").eqNullSafe(F.col("s")))
    epochs = spans.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))) \
        .withColumn("begin", F.col("start") + F.col("epoch") * F.col("all")) \
        .withColumn("end", F.least(F.col("stop") + F.col("epoch") * F.col("all"), "quota")) \
        .where("begin < end")
    pieces = epochs.withColumn("k", F.explode(F.sequence(
        F.expr(f"begin div {block}"), F.expr(f"(end - 1) div {block}")))) \
        .withColumn("from_word", F.greatest("begin", F.col("k") * block)) \
        .withColumn("to_word", F.least("end", (F.col("k") + 1) * block))
    base = F.col("start") + F.col("epoch") * F.col("all")
    takes = pieces.join(slots.withColumnRenamed("source", "o"),
                        F.col("source").eqNullSafe(F.col("o")) & (F.col("k") == F.col("rank"))) \
        .select("slot", "source", "doc_id", "epoch", "size", (F.col("from_word") - base).alias("from_word"),
                (F.col("to_word") - base).alias("to_word"))
    return sizes, targets, takes


def mix(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of each row: doc_id, source, size, source_size,
    target (of its source) and taken (words, repeats counted)."""
    sizes, targets, takes = schedule(docs, **options)
    scratch = Scratch(docs.sparkSession, "mixed")
    # Rows that share id, source and size share their takes evenly in order.
    key = [F.col("doc_id").alias("d"), F.col("source").alias("o"), F.col("size").alias("z")]
    took = takes.select(*key, (F.col("to_word") - F.col("from_word")).alias("n")) \
        .groupBy("d", "o", "z").agg(F.sum("n").alias("words"))
    alike = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows"))
    shared = scratch.table(alike.join(
        took, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("o"))
        & (F.col("size") == F.col("z")), "left")
        .select("doc_id", "source", "size", "rows", F.coalesce("words", F.lit(0)).alias("words")), "took")
    each = shared.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    taken = F.expr("i * words div rows - (i - 1) * words div rows")
    return each.withColumn("taken", taken).join(
        targets.select(F.col("source").alias("o"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("o"))) \
        .select("doc_id", "source", "size", "source_size", "target", "taken")


#: The same in DuckDB SQL: targets by the sorted caps, the points and whose
#: interval each lies in, and each document's overlap with its source's blocks
#: in two epochs.
MIX_SQL = r"""
WITH z AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
                  AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight
      FROM z GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight,
             encode(source) NULLS LAST) AS k FROM s),
q AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
             1.5::DOUBLE * sum(source_size) OVER () AS total FROM r),
l AS (SELECT (total - caps) / rest AS level FROM q
      WHERE weight * ((total - caps) / rest) <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CAST(least(cap, weight * (SELECT level FROM l)) AS DOUBLE) AS target FROM r),
n AS (SELECT source, target, sum(target) OVER () AS whole, coalesce(sum(target) OVER (ORDER BY encode(source) NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(target) OVER () AS low,
             row_number() OVER (ORDER BY encode(source) NULLS LAST) AS place FROM t WHERE target > 0),
i AS (SELECT *, coalesce(lead(low) OVER (ORDER BY place), 2.0) AS high FROM n),
y AS (SELECT greatest(1, least(BLOCK, CAST(floor(max(whole) / SLOTS) AS BIGINT))) AS block, max(whole) AS whole FROM n),
x AS (SELECT CAST(ceil(whole / block) AS BIGINT) AS blocks FROM y),
p AS (SELECT CAST(k AS DOUBLE) * GOLDEN - floor(CAST(k AS DOUBLE) * GOLDEN) AS point
      FROM unnest(generate_series(0, (SELECT blocks + blocks // SURPLUS + 3 FROM x))) AS g(k)),
b AS (SELECT place, count(*) AS slots FROM p JOIN i ON low <= point AND point < high GROUP BY place),
w AS (SELECT i.source, CAST(least(floor(i.target), (SELECT block FROM y) * coalesce(b.slots, 1)) AS BIGINT) AS quota
      FROM i LEFT JOIN b ON b.place = i.place),
o AS (SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source
             ORDER BY md5('mix|' || CAST(doc_id AS VARCHAR)), doc_id, size) - size AS a FROM z)
SELECT o.doc_id, o.source, o.size, t.source_size, t.target,
       CAST(greatest(0, least(a + o.size, coalesce(quota, 0)) - a)
          + greatest(0, least(a + o.size, coalesce(quota, 0) - source_size) - a) AS BIGINT) AS taken
FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source LEFT JOIN w ON o.source IS NOT DISTINCT FROM w.source
""".replace("GOLDEN", f"CAST({GOLDEN!r} AS DOUBLE)").replace("BLOCK", str(BLOCK)).replace("SLOTS", str(SLOTS)) \
    .replace("SURPLUS", str(SURPLUS))
