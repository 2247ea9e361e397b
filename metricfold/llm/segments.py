"""Substring dedup by line hashing: normalise units, group digests globally,
keep the earliest ranked occurrence, remove the rest with original offsets.

A unit is a line, or, as repeated passages also start and end inside lines, a
piece of one: a line is cut before a word whose hash is the least among its
SPREAD neighbours on both sides, a choice that depends on nearby words only.
Two copies of a passage are therefore cut alike, but for the words at their
edges, wherever they stand. (Whole lines alone miss such passages.) Words are
runs between ASCII white space, A-Z lower-cased; so units that differ only in
case or spacing have equal digests (128 bits). Units of fewer than MIN_WORDS
words stay: short phrases repeat by chance.

Whole units alone lose the ends of a passage, and all of one that is set in
short lines. So repeated_spans works on grams, the runs of MIN_WORDS words at
every word, across lines, in two steps:

1. Anchors: of any NEAR neighbouring grams the one with the least hash, and the
   first gram of every unit. Both copies of a passage of REACH words or more
   hold a common anchor, and a further one within NEAR words of each. A link is
   the text from an anchor to the end of the next one. Where a link has as many
   copies as both its anchors, all copies go on alike; such links join to
   chains. Counts show where to look; they decide nothing.
2. Chains, and the grams less than NEAR words from the ends of each chain, are
   grouped by their digests (128 bits), a share of the digests at a time, which
   bounds the disk that the shuffles take. One with an earlier occurrence is a
   repeat. Overlapping and adjoining repeats are one span, whose ends are exact
   to the word. But one word at an end that fewer than half of the copies
   share goes on to other text and agrees by chance: it stays, unless a unit
   begins or ends there.

So a repeated passage of REACH words or more is found whole, a shorter one (of
MIN_WORDS or more) whole if one of its anchors is common.

The rank of an occurrence is (doc_id, offset). Digests are grouped by a partial
aggregate, so a line in a third of all documents is reduced before the shuffle;
digests that repeat go to a table, which keeps their join open to splitting.

Defined results: null and empty texts have no units; repeated rows of one
doc_id are one document if their texts are equal (the same offsets stay), and
otherwise share the rank of their doc_id; a null doc_id ranks last and is
never removed. Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metricfold.llm.common import GOLD, Scratch, blocks_of, bounded, fresh_name, mix, prepare, word_hashes, word_spans

SPREAD = 6
MIN_WORDS = 8
NEAR = 25  # neighbouring grams of which one at least is an anchor
REACH = NEAR + MIN_WORDS - 1  # words that hold NEAR grams
PASSES = 3  # over the chains and grams, each for its share of the digests
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _least(h: np.ndarray, spread: int) -> np.ndarray:
    """Whether each word's hash is the least among its neighbours."""
    n = len(h)
    rank = mix(h + GOLD)
    low = np.ones(n, bool)
    for d in range(1, spread + 1):  # strictly below what precedes, at most what follows
        low[d:] &= rank[d:] < rank[:-d]
        low[:-d] &= rank[:-d] <= rank[d:]
    low[:spread] = False
    low[n - spread:] = False
    return low


def units(text: bytes | None, spread: int = SPREAD, min_words: int = MIN_WORDS):
    """Arrays (start, stop, words, digest, digest) of the units of a text that
    have min_words words or more; offsets count characters."""
    if not text:
        return (np.empty(0, np.int64),) * 5
    h = word_hashes(text)
    if not len(h):
        return (np.empty(0, np.int64),) * 5
    start, end = word_spans(text)
    cut = _line_cuts(h, _line_starts(text, start), spread)
    stop = np.append(cut[1:], len(h))
    n = stop - cut
    place = (np.arange(len(h)) - np.repeat(cut, n) + 1).astype(np.uint64)
    digests = [mix(np.add.reduceat(mix(h + place * p), cut) + n.astype(np.uint64)) for p in _ODD]
    keep = n >= min_words
    cut, stop = cut[keep], stop[keep]
    a, b = _characters(text, start[cut], end[stop - 1])
    return a, b, n[keep], digests[0][keep].view(np.int64), digests[1][keep].view(np.int64)


def _characters(text: bytes, *offsets: np.ndarray) -> list[np.ndarray]:
    """Byte offsets as character offsets."""
    raw = np.frombuffer(text, np.uint8)
    if raw.max() < 128:
        return list(offsets)
    begins = np.zeros(len(raw) + 1, np.int64)  # count the bytes that begin a character
    np.cumsum((raw & 0xC0) != 0x80, out=begins[1:])
    return [begins[x] for x in offsets]


def _line_starts(text: bytes, start: np.ndarray) -> np.ndarray:
    """Whether each word is the first of its line."""
    raw = np.frombuffer(text, np.uint8)
    line = np.searchsorted(np.flatnonzero((raw == 10) | (raw == 13)), start)
    first = np.ones(len(start), bool)
    first[1:] = line[1:] != line[:-1]
    return first


def _line_cuts(h: np.ndarray, first: np.ndarray, spread: int) -> np.ndarray:
    if len(h) <= 2 * spread:
        return np.flatnonzero(first)
    number = np.cumsum(first)
    inside = np.zeros(len(h), bool)  # the neighbourhood lies in one line
    inside[spread:len(h) - spread] = number[2 * spread:] == number[:len(h) - 2 * spread]
    return np.flatnonzero((_least(h, spread) & inside) | first)


class _Words:
    """The words of texts that are worked on at once, each on lines of its own."""

    def __init__(self, texts: list[bytes]):
        self.text = b"\n".join(texts)
        self.begin = np.cumsum([0] + [len(t) + 1 for t in texts])  # the byte at which each text begins
        self.start, self.end = word_spans(self.text)
        self.hash = word_hashes(self.text, (self.start, self.end))
        self.bounds = np.searchsorted(self.start, self.begin)  # the words before each text, and all
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each unit of MIN_WORDS words or more, and the one after its last."""
        cut = _line_cuts(self.hash, _line_starts(self.text, self.start), SPREAD)
        stop = np.append(cut[1:], len(self.hash))
        keep = stop - cut >= MIN_WORDS
        return cut[keep], stop[keep]

    def characters(self, owner: np.ndarray, *offsets: np.ndarray) -> list[np.ndarray]:
        """Byte offsets as character offsets in the text that owns them."""
        begin, *offsets = _characters(self.text, self.begin[:-1], *offsets)
        return [x - begin[owner] for x in offsets]


def _grams(h: np.ndarray, odd: np.uint64, at: np.ndarray) -> np.ndarray:
    """Digests of the MIN_WORDS words from each of the words ``at`` on."""
    places = np.arange(1, MIN_WORDS + 1, dtype=np.uint64) * odd
    total = np.zeros(len(at), np.uint64)
    for i in range(MIN_WORDS):
        total += mix(h[at + i] + places[i])
    return mix(total + np.uint64(MIN_WORDS))


def _sliding(x: np.ndarray, size: int, pick) -> np.ndarray:
    """np.minimum or np.maximum of every ``size`` neighbours."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def _chosen(g: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which grams are the least of some NEAR neighbours in their text, or of all if it has fewer."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    n = np.diff(np.append(first, len(g)))
    out = (np.repeat(n, n) < NEAR) & (g == np.repeat(np.minimum.reduceat(g, first), n))
    if len(g) >= NEAR:
        edge = np.zeros(NEAR - 1, np.uint64)
        least = _sliding(g, NEAR, np.minimum)
        least[owner[NEAR - 1:] != owner[:len(least)]] = 0
        out |= _sliding(np.concatenate([edge, least, edge]), NEAR, np.maximum) == g
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the anchors of texts: the text, the word of it at which they begin, their
    hashes and those of the links to the next (for the last one, to nothing)."""
    w = _Words(texts)
    h = w.hash
    grams = np.flatnonzero(w.owner[MIN_WORDS - 1:] == w.owner[:max(len(h) - MIN_WORDS + 1, 0)])
    if not len(grams):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    g = np.zeros(len(h), np.uint64)
    g[grams] = _grams(h, _ODD[0], grams)
    here = np.zeros(len(h), bool)
    here[grams] = _chosen(g[grams], w.owner[grams])
    here[w.units()[0]] = True
    at = np.flatnonzero(here)
    g, owner = g[at], w.owner[at]
    size = np.diff(np.append(at, len(h)))
    place = np.arange(at[0], len(h)) - np.repeat(at, size) + 1
    terms = mix(h[at[0]:] + place.astype(np.uint64) * _ODD[1])
    terms[w.owner[at[0]:] != np.repeat(owner, size)] = 0  # a text's words before its first anchor
    after = np.append(np.where(owner[1:] == owner[:-1], g[1:], GOLD), GOLD)
    return owner, at - w.bounds[owner], g, mix(np.add.reduceat(terms, at - at[0]) + after * _ODD[0])


def _emit_anchors(batches):
    for batch in batches:
        done = 0
        for texts in blocks_of(batch.column(1).to_pylist()):
            owner, at, g, link = anchors(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner + done)), pa.array(at.astype(np.int32)),
                 pa.array(g.view(np.int64)), pa.array(link.view(np.int64))], names=["key", "at", "g", "link"])
            done += len(texts)


def pieces(texts: list[bytes], owner: np.ndarray, at: np.ndarray, copies: np.ndarray, links: np.ndarray):
    """Arrays (text, at, words, start, stop, edge, digest, digest) of the chains of
    texts and the grams near their ends, from the repeated anchors, in order, and the
    copies of them and of their links. edge: whether a unit begins or ends with it."""
    w = _Words(texts)
    h = w.hash
    on = (copies[:-1] == copies[1:]) & (links[:-1] == copies[:-1]) & (owner[:-1] == owner[1:])  # goes on to the next
    heads, tails = np.append(True, ~on), np.append(~on, True)
    at = at + w.bounds[owner]
    begin, stop = w.bounds[owner], w.bounds[owner + 1] - MIN_WORDS + 1  # of the text's grams
    head, tail = at[heads], at[tails]
    opens = np.bincount(np.concatenate([np.maximum(head - NEAR + 1, begin[heads]), tail]), minlength=len(h) + 1) \
        - np.bincount(np.concatenate([head + 1, np.minimum(tail + NEAR, stop[tails])]), minlength=len(h) + 1)
    grams = np.flatnonzero(np.cumsum(opens) > 0)
    long = tail > head
    head, size = head[long], (tail - head)[long] + MIN_WORDS
    first = np.concatenate([grams, head])
    words = np.concatenate([np.full(len(grams), MIN_WORDS), size])
    offset = np.cumsum(size) - size
    place = np.arange(1, size.sum() + 1) - np.repeat(offset, size)
    chained, place = h[place + np.repeat(head - 1, size)], place.astype(np.uint64)
    digests = []
    for p in _ODD:
        total = np.add.reduceat(mix(chained + place * p), offset) if len(head) else np.empty(0, np.uint64)
        digests.append(np.concatenate([_grams(h, p, grams), mix(total + size.astype(np.uint64))]).view(np.int64))
    opening, closing = w.units()
    edge = np.zeros(len(h), bool)
    edge[opening] = edge[closing - MIN_WORDS] = True
    whose = w.owner[first]
    a, b = w.characters(whose, w.start[first], w.end[first + words - 1])
    return whose, first - w.bounds[whose], words, a, b, edge[first], *digests


def _emit_pieces(batches):
    for batch in batches:
        near = batch.column(3)
        count = np.diff(near.offsets.to_numpy())
        at, copies, links = (near.flatten().field(c).to_numpy() for c in ("at", "copies", "links"))
        owner = np.repeat(np.arange(batch.num_rows), count)
        order = np.lexsort((at, owner))
        same = (np.diff(at[order]) == 0) & (np.diff(owner[order]) == 0)
        order = order[np.append(True, ~same)[:len(order)]]  # equal rows of one doc_id share them
        owner, at, copies, links = (x[order] for x in (owner, at, copies, links))
        done = 0
        for texts in blocks_of(batch.column(2).to_pylist()):
            mine = slice(*np.searchsorted(owner, (done, done + len(texts))))
            whose, *got = pieces(texts, owner[mine] - done, at[mine], copies[mine], links[mine])
            rows = pa.array(whose + done)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows)]
                + [pa.array(x if x.dtype == bool else x.astype(np.int64)) for x in got],
                names=["doc_id", "key", "at", "words", "start", "stop", "edge", "d1", "d2"])
            done += len(texts)


def _emit(batches):
    for batch in batches:
        cols = [[] for _ in range(5)]
        owner = []
        for i, text in enumerate(batch.column(1)):
            got = units(text.as_py())
            owner.append(np.full(len(got[0]), i, np.int64))
            for col, x in zip(cols, got):
                col.append(x.astype(np.int64))
        owner = pa.array(np.concatenate(owner) if owner else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(owner)]
            + [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in cols],
            names=["doc_id", "start", "stop", "words", "d1", "d2"])


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The occurrences to remove: doc_id, start, stop (characters), words, and
    first_doc and first_start of the occurrence that stays."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "segments")
    found = scratch.table(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
        .mapInArrow(_emit, "doc_id long, start long, stop long, words long, d1 long, d2 long")
        .where("doc_id is not null"), "units")
    # The earliest occurrence by two plain minima: the first document, and in it the first offset.
    docs_of = found.groupBy("d1", "d2").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
        F.min("start").alias("low"), F.max("start").alias("high"))
    twice = scratch.table(docs_of.where("first_doc < last_doc or low < high")
                          .select("d1", "d2", "first_doc"), "repeated")
    again = found.join(twice, ["d1", "d2"])
    starts = scratch.table(
        again.where("doc_id = first_doc").groupBy("d1", "d2").agg(F.min("start").alias("first_start")),
        "starts")
    return again.join(starts, ["d1", "d2"]) \
        .where("doc_id <> first_doc or start <> first_start") \
        .select("doc_id", "start", "stop", "words", "first_doc", "first_start").distinct()


def _spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``repeated_spans`` with a hash of id and text, key."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "spans", tidy=True)
    doc_id = F.col(id_col).cast("long")
    texts = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text_col).alias("key"),
                        F.col(text_col).cast("binary").alias("text")).where("doc_id is not null")
    # Rows that repeat id and text are one document: one of each is worked on.
    again = bounded(scratch.table(texts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "again"))
    if not again.isEmpty():
        texts = texts.join(again, "key", "left_anti").unionByName(
            texts.join(again, "key", "left_semi").dropDuplicates(["key"]).select(*texts.columns))
    # 1. Copies of anchors that repeat, and of their links.
    found = scratch.table(texts.select("key", "text")
                          .mapInArrow(_emit_anchors, "key long, at int, g long, link long"), "anchors")
    twice = scratch.table(found.groupBy("g").agg(F.count("*").alias("copies")).where("copies > 1"), "repeated")
    every, found = found, scratch.table(found.join(twice, "g").select("key", "at", "link", "copies"), "found")
    scratch.drop(every, twice)
    links = scratch.table(found.groupBy("link").agg(F.count("*").alias("links")).where("links > 1"), "links")
    near = scratch.table(found.join(links, "link", "left").groupBy("key").agg(F.collect_list(F.struct(
        "at", "copies", F.coalesce("links", F.lit(1)).alias("links"))).alias("near")), "near")
    ids = bounded(scratch.table(near.select("key"), "ids"))
    # 2. Chains and the grams at their ends.
    parts = scratch.table(
        texts.join(ids, "key", "left_semi").join(near, "key").select("doc_id", "key", "text", "near")
        .mapInArrow(_emit_pieces, "doc_id long, key long, at long, words long, start long, stop long, "
                                  "edge boolean, d1 long, d2 long"), "pieces")
    scratch.drop(found, links, near)
    rank = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 40).cast("decimal(13,0)") + F.col("start").cast("decimal(12,0)")
    # By digest, in passes: only the shuffles of one pass are on disk at a time.
    repeats = []
    for i in range(PASSES):
        mine = parts.where(F.pmod("d1", F.lit(PASSES)) == i)
        ahead = scratch.table(mine.groupBy("d1", "d2").agg(
            F.min(rank).alias("first"), F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"))
            .where("copies > 1"), "ahead")
        repeats.append(scratch.table(
            mine.join(ahead, ["d1", "d2"]).where(rank != F.col("first"))
            .select("doc_id", "key", "at", (F.col("at") + F.col("words")).alias("end"), "start", "stop", "edge",
                    "first_doc", "copies"), "repeats"))
        scratch.drop(ahead)
    scratch.drop(parts)
    # Keys are worked on once, so (key, at, end) is unique. One shuffle and sort serve all windows.
    again = reduce(DataFrame.unionAll, repeats)
    order = Window.partitionBy("doc_id", "key").orderBy("at", "end")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    beside = {f"{side.__name__}_{c}": side(c).over(order) for side in (F.lag, F.lead) for c in ("at", "copies")}
    again = again.withColumns({"past": F.max("end").over(past), **beside}) \
        .withColumn("opens", F.coalesce(F.col("at") > F.col("past"), F.lit(True)))
    again = again.withColumns({
        "run": F.sum(F.col("opens").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "closes": F.coalesce(F.lead("opens").over(order), F.lit(True))})
    # An end is a gram with nothing of its run on one side.
    chance = F.expr("not edge and (opens and not closes and lead_at = at + 1 and lead_copies > 2 * copies "
                    "or closes and not opens and lag_at = at - 1 and lag_copies > 2 * copies)")
    return again.where(~F.coalesce(chance, F.lit(False))) \
        .groupBy("doc_id", "key", "run").agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_units"),
            (F.max("end") - F.min("at")).alias("n_words"), F.min("first_doc").alias("first_doc")) \
        .drop("run")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The passages to remove, exact to the word: doc_id, start, stop
    (characters), n_units (repeated chains and grams in it), n_words and first_doc
    (smallest id that keeps one of them)."""
    return _spans(docs, id_col, text_col).drop("key").distinct()


def remove_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated spans cut out of the text."""
    return _without(docs, _spans(docs, id_col, text_col), id_col, text_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed units cut out of the text."""
    return _without(docs, repeated_units(docs, id_col, text_col), id_col, text_col)


def _without(docs: DataFrame, pieces: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the pieces of their doc_id, and key if it is given."""
    names = {c: fresh_name(docs, f"_segments_{c}") for c in ("doc_id", "key") if c in pieces.columns}
    cut = fresh_name(docs, "_segments_cut")
    spans = pieces.groupBy(*names).agg(
        F.array_sort(F.collect_list(F.struct("start", "stop"))).alias(cut)).withColumnsRenamed(names)  # within one document
    doc_id = F.col(id_col).cast("long")
    mine = {"doc_id": doc_id, "key": F.xxhash64(doc_id, text_col)}
    joined = docs.join(spans, [mine[c] == F.col(x) for c, x in names.items()], "left")
    kept = F.aggregate(
        cut, F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda acc, x: F.struct(
            F.concat(acc["text"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"),
                                              (x["start"] - acc["at"]).cast("int"))).alias("text"),
            x["stop"].alias("at")),
        lambda acc: F.concat(acc["text"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"),
                                                      F.length(text_col))))
    new = F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(kept)
    return joined.withColumn(text_col, new).select(*docs.columns)
