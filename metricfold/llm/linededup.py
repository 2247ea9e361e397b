"""Line dedup within one edit, by a deletion-neighbourhood join. DataFrame and
SQL functions only.

A line is removed if an earlier line, by (doc_id, line number), is equal to it
or within edit distance 1 of it, after trimming white space at both ends and
lower-casing A-Z. Whether that earlier line is removed itself makes no
difference. Lines of fewer than MIN_CHARS characters are compared for equality
only: one edit makes other words of them. Blank lines stay.

1. Equal lines are one class; its rank is its earliest occurrence.
2. Two lines one edit apart agree in their first or their last L characters,
   L being half of the shorter one. Classes that share no such half with
   another are done: the join below could not match them. (Two lengths of L
   per line cover partners that are longer or shorter by one.)
3. The others emit a key for the line and for each variant with one character
   deleted. A key is the XOR of 64-bit hashes of each character with its place,
   so that it depends on the order. A deletion keeps the terms before it and
   moves those after it by one place; running XORs (in blocks of BLOCK) give
   both, so that a line of n characters costs n steps however long it is.
   Equal keys mean equal variants, but for collisions of 64 bits.
4. Variants are joined by grouping: lines with equal variants of the same
   deleted position differ by a substitution there, all of them from one
   another; a line equal to a variant of others is one insertion from them.
   So each group's earliest line answers for the whole group, and no pairs
   within a group are made.
5. The edit distance of each line and its found candidates is verified.

Defined results: null and empty texts have no lines; repeated rows with the
same doc_id and text are one document, and their lines stay or go together;
rows with the same doc_id and different texts share ranks by line number; a
null doc_id ranks last and its lines stay. Extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricfold.llm.common import Scratch, bounded, fresh_name, prepare

MIN_CHARS = 16
#: Characters of a line whose running XORs are appended to one array.
BLOCK = 64
#: Characters of the lines that one task turns into variants.
PART_CHARS = 1 << 20
SPACE = " \t\r\x0b\x0c"


def normal(line):
    """Trimmed at both ends, with A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(SPACE)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    parts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")) \
        .where("doc_id is not null")
    return parts.select("doc_id", F.col("line_no").cast("long").alias("line_no"),
                        normal(F.col("line")).alias("line")) \
        .where("line <> ''")


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line"))


def _halves(n):
    """Hashes of the halves in which a line can agree with one an edit away."""
    def pair(size):
        return F.array(F.xxhash64(F.lit(0), size, F.substr("line", F.lit(1), size)),
                       F.xxhash64(F.lit(1), size, F.substr("line", n - size + 1, size)))
    return F.array_distinct(F.concat(pair(F.floor(n / 2).cast("int")), pair(F.floor((n - 1) / 2).cast("int"))))


def _let(value, body):
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _xor(values):
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x))


def _running(values, start):
    """``start``, and its XOR with each longer head of the values."""
    return F.aggregate(values, F.array(start), lambda acc, x: F.concat(
        acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))


def _before(values):
    """For each value, the XOR of those before it."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
                         lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    return _let(blocks, lambda bs: _let(
        _running(F.transform(bs, _xor), F.lit(0).cast("long")),
        lambda bases: F.flatten(F.transform(bs, lambda x, b: F.slice(
            _running(x, F.element_at(bases, b + 1)), 1, F.size(x))))))


def _variants(chars):
    """(pos, v) of the line itself (pos 0) and of its single deletions."""
    def both(here, left):  # terms of the characters at their places, and one place to the left
        n = F.size(here)
        own = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(_xor(here), n).alias("v")))
        cut = _let(_xor(left), lambda rest: F.transform(
            F.zip_with(_before(F.zip_with(here, left, lambda x, y: x.bitwiseXOR(y))), left,
                       lambda x, y: x.bitwiseXOR(y)),
            lambda x, i: F.struct((i + 1).alias("pos"), F.xxhash64(rest.bitwiseXOR(x), n - 1).alias("v"))))
        return F.concat(own, cut)
    return _let(chars, lambda c: _let(
        F.transform(c, lambda x, i: F.xxhash64(x, i + 1)),
        lambda here: _let(F.transform(c, lambda x, i: F.xxhash64(x, i)), lambda left: both(here, left))))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines to remove: doc_id, line_no (from 0), first_doc and first_line
    of the earliest line that it repeats, and edits (0 or 1) between the two."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "lines")
    keyed = _keyed(_lines(docs, id_col, text_col))
    n = F.length("line")
    occ = scratch.table(keyed.select("doc_id", "line_no", "h1", "h2", F.when(n >= MIN_CHARS, _halves(n)).alias("halves")),
                        "lines")
    # 1. Classes of equal lines, and their earliest occurrence by two plain minima.
    # (A table, so that the join of a line that many documents hold can be split.)
    first = scratch.table(occ.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc")), "first")
    starts = occ.select("doc_id", "line_no", "h1", "h2").join(first, ["h1", "h2"]) \
        .where("doc_id = first_doc").groupBy("h1", "h2") \
        .agg(F.first("first_doc").alias("first_doc"), F.min("line_no").alias("first_line"))
    classes = scratch.table(starts, "classes")
    # 2. Classes that share a half with another class.
    halves = occ.select("h1", F.explode("halves").alias("half"))
    crowded = bounded(scratch.table(
        halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a < b").select("half"),
        "crowded"))
    near = occ.select("h1", "h2", F.explode("halves").alias("half")).join(crowded, "half", "left_semi") \
        .select("h1", "h2").distinct()
    near = scratch.table(near.join(classes, ["h1", "h2"]), "near")
    origins = bounded(scratch.table(near.select(F.col("first_doc").alias("_near_doc")).distinct(), "origins"))
    texts = _keyed(_lines(docs.join(origins, F.col(id_col).cast("long") == F.col("_near_doc"), "left_semi"), id_col, text_col)) \
        .join(near.select("first_doc", "first_line", "h1", "h2"), ["h1", "h2"]) \
        .where("doc_id = first_doc and line_no = first_line") \
        .select("h1", "h2", "first_doc", "first_line", "line").dropDuplicates(["h1", "h2"])
    texts = scratch.table(texts, "texts")
    chars = texts.agg(F.sum(F.length("line"))).first()[0] or 0
    # A number that rises with the rank. Parts by characters, each of which becomes a row below.
    ranked = scratch.table(
        texts.repartitionByRange(1 + chars // PART_CHARS, "first_doc", "first_line").sortWithinPartitions("first_doc", "first_line", "h1", "h2")
        .withColumn("rank", F.monotonically_increasing_id()), "ranked")
    # 3. and 4.
    emitted = ranked.select("rank", F.inline(_variants(F.split("line", ""))))
    # One shuffle serves both groupings; classes are distinct, so groups are small.
    met = emitted.repartition("v") \
        .withColumn("lead", F.min("rank").over(Window.partitionBy("v", "pos"))) \
        .withColumn("whole", F.min(F.when(F.col("pos") == 0, F.col("rank"))).over(Window.partitionBy("v"))) \
        .where("pos > 0")
    found = scratch.table(met.select(F.inline(F.array(
        F.struct("rank", F.col("lead").alias("other")),
        F.struct(F.greatest("rank", "whole").alias("rank"), F.least("rank", "whole").alias("other")))))
        .where("other < rank").distinct(), "candidates")
    # 5.
    x = ranked.select("rank", F.col("line").alias("x"), "h1", "h2")
    y = ranked.select(F.col("rank").alias("other"), F.col("line").alias("y"))
    edits = found.join(x, "rank").join(y, "other").where(F.levenshtein("x", "y", 1) == 1) \
        .groupBy("rank", "h1", "h2").agg(F.min("other").alias("other"))
    origin = ranked.select(F.col("rank").alias("other"), F.col("first_doc").alias("near_doc"),
                           F.col("first_line").alias("near_line"))
    edits = scratch.table(edits.join(origin, "other").select("h1", "h2", "near_doc", "near_line"), "edits")
    own = F.col("near_doc").isNull()
    return occ.select("doc_id", "line_no", "h1", "h2").join(classes, ["h1", "h2"]).join(edits, ["h1", "h2"], "left") \
        .where("near_doc is not null or doc_id <> first_doc or line_no <> first_line") \
        .select("doc_id", "line_no", F.when(own, F.col("first_doc")).otherwise(F.col("near_doc")).alias("first_doc"),
                F.when(own, F.col("first_line")).otherwise(F.col("near_line")).alias("first_line"),
                F.when(own, F.lit(0)).otherwise(F.lit(1)).alias("edits")).distinct()


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated lines. A text that had lines and keeps
    none but blank ones becomes empty; null and untouched texts stay as they are."""
    gone = repeated_lines(docs, id_col, text_col).groupBy("doc_id") \
        .agg(F.collect_set("line_no").alias("gone"))  # the lines of one document
    key, cut = fresh_name(docs, "_line_doc"), fresh_name(docs, "_line_gone")
    gone = gone.withColumnsRenamed({"doc_id": key, "gone": cut})
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(
        F.col(cut), i.cast("long"))), "\n")
    new = F.when(F.col(cut).isNull() | F.col(text_col).isNull(), F.col(text_col)).otherwise(kept)
    return docs.join(gone, F.col(id_col).cast("long") == F.col(key), "left") \
        .withColumn(text_col, new).select(*docs.columns)


#: The same in DuckDB SQL: lines that share a half, compared by edit distance.
LINES_SQL = r"""
WITH l AS (SELECT doc_id, CAST(i - 1 AS BIGINT) AS line_no, translate(trim(p[i], chr(32) || chr(9) || chr(13)
             || chr(11) || chr(12)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), unnest(generate_series(1, len(p))) AS t(i)),
k AS (SELECT * FROM l WHERE line <> ''),
c AS (SELECT line, first_doc, first_line, row_number() OVER (ORDER BY first_doc, first_line) AS r
      FROM (SELECT line, min(s).doc_id AS first_doc, min(s).line_no AS first_line
            FROM (SELECT line, {'doc_id': doc_id, 'line_no': line_no} AS s FROM k) GROUP BY line)),
h AS (SELECT r, line, z, left(line, z) AS part, 0 AS side FROM c, unnest([length(line) // 2, (length(line) - 1) // 2]) AS t(z) WHERE length(line) >= 16
      UNION SELECT r, line, z, right(line, z), 1 FROM c, unnest([length(line) // 2, (length(line) - 1) // 2]) AS t(z) WHERE length(line) >= 16),
e AS (SELECT b.r, min(a.r) AS other FROM h a JOIN h b ON a.part = b.part AND a.side = b.side AND a.z = b.z AND a.r < b.r
        AND abs(length(a.line) - length(b.line)) <= 1
      WHERE levenshtein(a.line, b.line) = 1 GROUP BY b.r),
m AS (SELECT c.line, c.first_doc, c.first_line, o.first_doc AS near_doc, o.first_line AS near_line
      FROM c LEFT JOIN e USING (r) LEFT JOIN c o ON o.r = e.other)
SELECT k.doc_id, k.line_no, coalesce(near_doc, first_doc) AS first_doc, coalesce(near_line, first_line) AS first_line,
       CASE WHEN near_doc IS NULL THEN 0 ELSE 1 END AS edits
FROM k JOIN m USING (line)
WHERE near_doc IS NOT NULL OR k.doc_id <> first_doc OR k.line_no <> first_line
"""
