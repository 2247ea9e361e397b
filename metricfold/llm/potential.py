"""Filter interaction audit by the potential of the removal game.

Five filters (A to E) are applied to all documents. Each document fails some
of them, so the corpus is a table of counts by part (source) and set of failed
filters, at most 32 rows a part, and everything the audit reports follows
from it: the game v(S) of a coalition S of filters is the number of documents
that fail at least one filter of S. Coalition differences supply the steps: a
filter applied after the coalition S removes v(S + f) - v(S). The potential
(Hart and Mas-Colell) is computed recursively over the 32 coalitions,

    P(S) = (v(S) + sum over f in S of P(S - f)) / |S|,    P of nothing = 0,

and a filter's Shapley value is P(all) - P(all but f). It is the mean of the
filter's removals over all 120 orders, so 120 times the potential is a whole
number and is what is computed; the report gives that sum. Documents of good
quality and toxic ones have games of their own, by coalition differences too.

Only E compares documents: equal texts meet by the digest of the text, the
one with the smallest id stands, the others fail. Rows are summed by digest,
part and id before the shuffle, so a text that a third of all rows share, in a
few sources, is one row for each id there and then one for each part.

Results: 600 rows (120 orders of 5 steps) for each value of the source, the
null one as the empty string (as an empty source is). A null text counts as
empty; it fails A (under 50 words), and E beside an earlier empty text. Rows
that repeat with the same id and text are all counted, and the smallest id
stands with all its rows; rows without an id fail no E and carry no labels.
A document with several label rows is good (toxic) if one of them says so.
An empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

FILTERS = "ABCDE"
#: Fixed values of the filters.
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, MARKS = 50, 65, 5, "[#$%&*|]"
_SPACES = r"[\x20\x09-\x0D]+"


def failures(text: Column) -> list[Column]:
    """Whether a text fails A, B, C, D (E compares documents)."""
    words = F.filter(F.split(text, _SPACES), lambda w: w != "")
    return [F.size(words) < MIN_WORDS,
            100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")) > CAPITALS_PERCENT * F.length(text),
            text.rlike(MARKS)]


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and set of failed
    filters (bit 0 is A), with those of good quality and the toxic ones."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "audit")
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(text))])
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), bits.alias("mask"))
    # One row per text, part and id; a table, so that a hot id can be split in the join.
    known = scratch.table(rows.groupBy("digest", "mask", "part", "id").agg(F.count(F.lit(1)).alias("n")), "rows")
    marks = scratch.table(labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"))
                          .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                               F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")), "labels")
    k = known.join(marks, "id", "left").select(
        "digest", "mask", "part", "id", "n", (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    sums, has_id = ("n", "good", "toxic"), F.col("id").isNotNull()
    by_part = k.groupBy("digest", "mask", "part").agg(
        F.min("id").alias("first"),
        *[F.sum(c).alias(c) for c in sums],
        *[F.coalesce(F.sum(F.when(has_id, F.col(c))), F.lit(0)).alias(f"{c}_known") for c in sums],
        *[F.coalesce(F.min_by(c, "id"), F.lit(0)).alias(f"{c}_first") for c in sums])
    # A text's group here is one row for each part that holds it.
    least = F.min("first").over(Window.partitionBy("digest"))
    later = by_part.withColumn("_stands", F.coalesce(F.col("first") == least, F.lit(False))).select(
        "part", "mask", *sums,
        *[(F.col(f"{c}_known") - F.when(F.col("_stands"), F.col(f"{c}_first")).otherwise(0)).alias(f"{c}_e") for c in sums])
    two = F.array(F.struct("mask", *[(F.col(c) - F.col(f"{c}_e")).alias(c) for c in sums]),
                  F.struct((F.col("mask") + 16).alias("mask"), *[F.col(f"{c}_e").alias(c) for c in sums]))
    return later.select("part", F.inline(two)).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in sums])


def games(counts: DataFrame) -> DataFrame:
    """(part, all, n, good, toxic, only): for each part its documents and, as
    arrays over the 32 coalitions, the removal games of all, good and toxic
    documents; ``only`` counts by set of failed filters."""
    def game(c: str) -> Column:
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in range(32)])

    return counts.groupBy("part").agg(F.sum("n").alias("all"), *[game(c).alias(c) for c in ("n", "good", "toxic")],
                                      F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0))
                                                for i in range(5)]).alias("only"))


def potentials(game: Column) -> Column:
    """120 times the potential of each of the 32 coalitions of a game, in the
    order of their bits: each from those with one filter less. (A coalition's
    number is above those of its subsets, so an ordered fold meets them first.)"""
    def grow(done: Column, s: Column) -> Column:
        members = F.filter(F.array(*[F.lit(1 << i) for i in range(5)]), lambda b: s.bitwiseAND(b) != 0)
        below = F.aggregate(members, F.lit(0).cast("long"), lambda t, b: t + F.get(done, s - b))
        p = (F.lit(120) * F.get(game, s) + below).cast("decimal(38,0)") / F.size(members)
        return F.concat(done, F.array(p.cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), F.array(F.lit(0).cast("long")), grow)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for every part, order and step."""
    g = games(failure_counts(docs, labels, id_col, text_col, part_col)) \
        .withColumn("potential", potentials(F.col("n")))
    steps = []
    for order in permutations(range(5)):
        before = 0
        for i, f in enumerate(order):
            steps.append({"filter_order": "".join(FILTERS[x] for x in order), "step": i + 1, "f": f, "before": before})
            before |= 1 << f
    table = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,f:int,before:int>>")
    each = g.select("*", F.inline(table)) \
        .withColumn("bit", F.expr("shiftleft(1, f)")).withColumn("after", F.col("before") + F.col("bit"))

    def won(c: str) -> Column:
        return F.get(c, F.col("after")) - F.get(c, F.col("before"))

    return each.select(
        "part", "filter_order", "step", (F.col("all") - F.get("n", F.col("after"))).alias("kept"),
        won("n").alias("removed"), (F.get("n", F.col("bit")) - won("n")).alias("redundant"),
        F.get("only", F.col("f")).alias("unique_fails"), won("good").alias("good_lost"),
        won("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(31)) - F.get("potential", 31 - F.col("bit"))).alias("shapley"))


#: The same report in DuckDB SQL, document by document and order by order.
AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
first AS (SELECT body, min(doc_id) AS doc_id FROM d GROUP BY body),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT w.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
        CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(w.body, '[^A-Z]', '', 'g')) > 5 * length(w.body) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(w.body, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN w.doc_id > first.doc_id THEN 'E' ELSE '' END AS fails
      FROM w JOIN first ON w.body = first.body LEFT JOIN l ON w.doc_id = l.doc_id),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
t AS (SELECT part, filter_order, step, f, n, good, toxic, fails, contains(fails, f) AS hit,
             earlier <> '' AND regexp_matches(fails, '[' || earlier || 'Z]') AS gone FROM g, s),
r AS (SELECT part, filter_order, step, f,
        CAST(sum(CASE WHEN hit OR gone THEN 0 ELSE n END) AS BIGINT) AS kept,
        CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
        CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
        CAST(sum(CASE WHEN fails = f THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
        CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
        CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
      FROM t GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r"""
