"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is encoded twice: a byte-level vocabulary (A, a ``.json`` file) reads
a space and the text, a piece vocabulary (B, a ``.model`` file) the text, before
which it puts a space itself. An A and a B token are linked where their bytes
overlap. Documents are dealt into blocks of consecutive rows. For every pair of
ids (a, b) linked in a block, the block holds the documents that have it as
compressed bitmaps: one plane for each binary digit of the number of links, so
the union (OR) of the planes is the pair's set of documents and the planes
together its links. A container is a list of places where few documents hold
the pair and a bitmap where many do, as in the compressed bitmaps in common
use; the planes of a block are then packed with zstandard.

The union of a pair's bitmaps over all blocks is counted by adding the blocks'
population counts, which are partial sums before the shuffle: one row for each
pair and block, however often the pair occurs. The counts then go back to the
blocks that hold the pair, and the postings return them to the documents: each
plane adds its weight times the pair's count to every document it names.

Both tokenizers break at a space between two letters, digits or common marks,
so a text is taken apart there and each different piece is encoded once in a
task; the table of pieces is emptied at ``WORDS`` entries.

Results: one row per input row, repeated rows included, each a document of its
own in all counts. A null or empty text, and one whose tokens do not give back
the bytes of a space and the text (as with U+2581), has zeros and an empty
``groups_sha256`` and counts nowhere. An empty table gives no rows. A text of
any length is encoded whole, piece by piece, and its links are merged as they
come; a very long stretch without a place to break is one piece. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

#: A block ends at this many documents or characters; pieces taken at a time,
#: and pieces that a task remembers.
BLOCK_DOCS, BLOCK_CHARS = 1 << 14, 1 << 24
SLICE, WORDS = 200_000, 400_000
TOGETHER = 64  # new pieces encoded as one text

_PLACE = 15  # binary digits of a document's place in its block
_ID = 24     # binary digits of a token id
_MARKS = r"[\w.,;:!?'\"()\-]"
_EDGES = frozenset(string.ascii_letters + string.digits + "_.,;:!?'\"()-")
BREAK = re.compile(f"(?<={_MARKS}) (?={_MARKS})")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable
    ones stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """The two tokenizers, with the bytes of each token."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        vocab = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [b"" if t is None else bytes([alphabet[c] for c in t]) if all(c in alphabet for c in t)
                        else t.encode() for t in map(vocab.get, range(max(vocab) + 1))]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # Texts of all ids with what may follow them: a comma, a bar, a semicolon, nothing.
        names = [str(i) for size in (len(self.a_bytes), len(self.b_bytes)) for i in range(size)]
        self.texts = np.array([n + after for after in (",", "|", ";", "") for n in names], object)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        # By piece: tokens of A and of B, groups, whether its bytes differ; then
        # its links, one after the other, with their starts.
        self._sizes: list[np.ndarray] = []
        self._links: list[np.ndarray] = []
        self._starts: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.total = 0

    def learn(self, pieces: list[str]) -> None:
        """Encodes pieces not met before, some of them joined by the spaces that
        both tokenizers break at; where the tokens then do not end at the
        pieces' ends, or their bytes differ, each on its own."""
        joined = [p for p in pieces if p[0] in _EDGES and p[-1] in _EDGES or p[0].isalnum() and p[-1].isalnum()]
        if len(joined) < len(pieces):
            apart = set(joined)
            pieces = joined + [p for p in pieces if p not in apart]
        raw = [b" " + p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        good = np.array(["\u2581" not in p for p in pieces])  # U+2581 is a space to B
        texts = [p for p, g in zip(joined, good.tolist()) if g]
        texts = [" ".join(texts[i:i + TOGETHER]) for i in range(0, len(texts), TOGETHER)] \
            + [p for p, g in zip(pieces[len(joined):], good[len(joined):].tolist()) if g]
        a, b = (_flat(x)[0] for x in self._encode(texts))
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        borders = np.cumsum(sizes * good)
        at = borders[good]
        if len(at) and not (len(a) and len(b) and np.isin(at, ends_a).all() and np.isin(at, ends_b).all()
                            and b"".join(map(self.a_bytes.__getitem__, a.tolist()))
                            == b"".join([r for r, g in zip(raw, good.tolist()) if g])
                            == b"".join(map(self.b_bytes.__getitem__, b.tolist()))):
            in_a, in_b = self._encode(pieces)
            good &= np.array([b"".join(map(self.a_bytes.__getitem__, xa)) == r == b"".join(map(self.b_bytes.__getitem__, xb))
                              for r, xa, xb in zip(raw, in_a, in_b)])
            a, b = (_flat([x if g else [] for x, g in zip(y, good.tolist())])[0] for y in (in_a, in_b))
            ends_a, ends_b, borders = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(sizes * good)
        n_a, n_b = (np.diff(np.searchsorted(ends, borders, side="right"), prepend=0) for ends in (ends_a, ends_b))
        cut = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        cut = cut[np.diff(cut, prepend=-1) > 0]  # before each cut lie one A and one B token
        at_a, at_b = np.searchsorted(ends_a, cut), np.searchsorted(ends_b, cut)
        to = np.searchsorted(cut, borders, side="right")
        shared = (ends_a[at_a] == cut) & (ends_b[at_b] == cut) if len(cut) else np.zeros(0, bool)
        before = np.concatenate([[0], np.cumsum(shared)])
        n_groups = np.diff(before[to], prepend=0)
        first = len(self.groups)
        self.groups += self._grouped(a, b, ends_a, ends_b, cut[shared], n_a, n_b, borders)
        self.known.update(zip(pieces, range(first, len(self.groups))))
        self._sizes.append(np.column_stack([n_a, n_b, n_groups, ~good]))
        self._links.append(a[at_a] << _ID | b[at_b])
        self._starts.append(to + self.total)
        self.total += len(cut)

    def _encode(self, texts: list[str]) -> tuple[list, list]:
        """The ids of some texts: A reads a space before each, B adds it."""
        return ([e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)],
                self.b.encode(texts, num_threads=1))

    def _grouped(self, a, b, ends_a, ends_b, shared, n_a, n_b, borders) -> list[str]:
        """The groups of each piece as text: each token's id with what follows it."""
        group = np.concatenate([np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(group * 2 + side, kind="stable")
        group, side = group[order], side[order]
        ids = np.concatenate([a, b + len(self.a_bytes)])[order]
        piece_end = np.isin(shared, borders)[group]
        same_group = np.append(group[1:] == group[:-1], False)
        same_side = np.append(side[1:] == side[:-1], False)
        after = np.where(same_group, np.where(same_side, 0, 1), np.where(piece_end, 3, 2))
        words = self.texts[after * (len(self.texts) // 4) + ids].tolist()
        ends = np.cumsum(n_a + n_b).tolist()
        return ["".join(words[i:j]) for i, j in zip([0, *ends[:-1]], ends)]

    def lookup(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in dict.fromkeys(pieces) if p not in self.known]
        if new:
            self.learn(new)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes of all known pieces, their links and the links' starts."""
        for t in (self._sizes, self._links, self._starts):
            if len(t) > 1:
                t[:] = [np.concatenate(t)]
        return self._sizes[0], self._links[0], self._starts[0]


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The rows' numbers one after the other, and how many each row has."""
    n = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(itertools.chain.from_iterable(rows), np.int64, n.sum()), n


def _gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` named by ``which``, and their lengths."""
    n = starts[which + 1] - starts[which]
    at = np.repeat(starts[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    return flat[at], n


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order with their summed counts."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable") if counts is not None else None
    s = keys[order] if counts is not None else np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    if counts is None:
        return s[first], np.diff(np.append(first, len(s)))
    return s[first], np.add.reduceat(counts[order], first)


class Block:
    """One block's documents and the links found in them so far."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.chars = 0
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, links: np.ndarray, place) -> None:
        self.parts.append(_summed(links << _PLACE | place))
        if sum(len(k) for k, _ in self.parts) > 4_000_000:
            self.fold()

    def fold(self) -> None:
        parts = [(self.keys, self.counts), *self.parts]
        self.keys, self.counts = _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        self.parts = []


def pack(pair: np.ndarray, place: np.ndarray, n_pairs: int, n_docs: int) -> bytes:
    """One plane: for each pair its documents' places, as a list where they are
    few and as a bitmap where that is shorter."""
    n = np.bincount(pair, minlength=n_pairs).astype(np.uint16)
    dense = n > max(n_docs // 16, 1)
    of_dense = dense[pair]
    rank = np.cumsum(dense) - 1
    width = (n_docs + 7) // 8
    bits = np.zeros((int(dense.sum()), width * 8), bool)
    bits[rank[pair[of_dense]], place[of_dense]] = True
    body = n.tobytes() + place[~of_dense].astype(np.uint16).tobytes() + np.packbits(bits, axis=1).tobytes()
    head = np.array([n_pairs, n_docs, len(body)], np.int64).tobytes()
    return head + pa.compress(body, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(pair, place) of every bit of a plane."""
    n_pairs, n_docs, size = (int(x) for x in np.frombuffer(blob, np.int64, 3))
    body = pa.decompress(blob[24:], decompressed_size=size, codec="zstd", asbytes=True)
    n = np.frombuffer(body, np.uint16, n_pairs).astype(np.int64)
    dense = n > max(n_docs // 16, 1)
    few = int(n[~dense].sum())
    place = np.frombuffer(body, np.uint16, few, 2 * n_pairs).astype(np.int64)
    width = (n_docs + 7) // 8
    bits = np.unpackbits(np.frombuffer(body, np.uint8, offset=2 * (n_pairs + few)).reshape(-1, width), axis=1)
    row, col = np.nonzero(bits)
    pairs = np.arange(n_pairs)
    return (np.concatenate([np.repeat(pairs[~dense], n[~dense]), np.flatnonzero(dense)[row]]),
            np.concatenate([place, col]))


def _encode(ids, texts, two: Pair, block: Block) -> None:
    """Adds rows to a block: few pieces at a time, so that one long text needs
    little memory."""
    at = 0
    while at < len(texts):
        size, pieces, owner, chosen = 0, [], [], []
        while at < len(texts) and size < SLICE:  # short texts together, a long one alone
            found = BREAK.split(texts[at]) if texts[at] else []
            if pieces and size + len(found) > SLICE:
                break
            pieces += found
            owner.append(len(found))
            chosen.append(at)
            size += len(found)
            at += 1
        if len(two.known) > WORDS:
            two.forget()
        first = len(block.rows)
        digests = [hashlib.sha256() for _ in chosen]
        sums = np.zeros((len(chosen), 4), np.int64)  # tokens of A, of B, groups, pieces that differ
        doc = np.repeat(np.arange(len(chosen)), owner)
        kept = []
        for i in range(0, len(pieces), SLICE):
            which, of = two.lookup(pieces[i:i + SLICE]), doc[i:i + SLICE]
            sizes, links, starts = two.tables()
            np.add.at(sums, of, sizes[which])
            edges = np.flatnonzero(np.diff(of, prepend=-1, append=-1))
            for lo, hi in zip(edges[:-1], edges[1:]):
                text = ";".join([two.groups[w] for w in which[lo:hi].tolist()])
                digests[of[lo]].update((";" if i and lo == 0 and of[0] == doc[i - 1] else "").encode() + text.encode())
            found, n = _gather(links, starts, which)
            kept.append((found, np.repeat(of, n)))
            if len(two.known) > WORDS and i + SLICE < len(pieces):
                two.forget()
        good = (sums[:, 3] == 0) & (sums[:, 0] > 0)
        for found, of in kept:
            use = good[of]
            block.add(found[use], first + of[use])
        for j, k in enumerate(chosen):
            a, b, groups = sums[j, :3].tolist() if good[j] else (0, 0, 0)
            block.rows.append((ids[k], a, b, groups, digests[j].hexdigest() if good[j] else ""))
            block.chars += len(texts[k] or "")


def _block_row(block: Block, number: int, schema: pa.Schema) -> pa.RecordBatch:
    """A block as one row: its documents, its pairs with their numbers of
    documents, and the planes of bitmaps."""
    block.fold()
    pair_of, place = block.keys >> _PLACE, block.keys & ((1 << _PLACE) - 1)
    first = np.flatnonzero(np.diff(pair_of, prepend=-1))
    pairs, index = pair_of[first], np.cumsum(np.diff(pair_of, prepend=-1) != 0) - 1
    planes = []
    for k in range(int(block.counts.max()).bit_length() if len(block.counts) else 0):
        has = block.counts >> k & 1 == 1
        planes.append(pack(index[has], place[has], len(pairs), len(block.rows)))
    ids, a, b, groups, digest = zip(*block.rows)
    data = [number, list(ids), list(a), list(b), list(groups), list(digest), pairs,
            np.diff(np.append(first, len(pair_of))).astype(np.int32), planes]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(data, schema)], schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          block_docs: int = BLOCK_DOCS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row; see the module's text. ``a_path`` and ``b_path`` are read on the
    driver."""
    spark = prepare(docs.sparkSession)
    if not 0 < block_docs <= 1 << _PLACE:
        raise ValueError("a block's documents must have places below 2**15")
    with open(a_path, encoding="utf-8") as fa, open(b_path, "rb") as fb:
        files = spark.sparkContext.broadcast((fa.read(), fb.read()))
    kind = docs.schema[id_col].dataType
    longs = ["n_a", "n_b", "n_groups"]
    table = f"block long, ids array<{kind.simpleString()}>, " + ", ".join(f"{c} array<long>" for c in longs) \
        + ", groups_sha256 array<string>, pairs array<long>, docs array<int>, planes array<binary>"

    def blocks(batches):
        two, block, number, schema = Pair(*files.value), Block(), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            if schema is None:
                id_type = batch.schema.field("id").type
                schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(id_type)),
                                    *((c, pa.list_(pa.int64())) for c in longs),
                                    ("groups_sha256", pa.list_(pa.string())), ("pairs", pa.list_(pa.int64())),
                                    ("docs", pa.list_(pa.int32())), ("planes", pa.list_(pa.binary()))])
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            step = min(64, block_docs)
            for i in range(0, len(ids), step):
                if block.rows and (len(block.rows) + step > block_docs or block.chars > block_chars):
                    yield _block_row(block, number, schema)
                    block, number = Block(), number + 1
                _encode(ids[i:i + step], texts[i:i + step], two, block)
        if block.rows:
            yield _block_row(block, number, schema)

    scratch = Scratch(spark, "alignment")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    index = scratch.table(rows.mapInArrow(blocks, table), "blocks")

    # Documents of each pair: one row per pair and block, summed before the shuffle.
    held = index.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    counts = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("n"))
    # A token's pairs are at most as many as B has tokens.
    mine = Window.partitionBy(F.shiftright("pair", _ID))
    scores = scratch.table(counts.withColumn("best", F.col("n") == F.max("n").over(mine)), "scores")
    back = index.select("block", F.explode("pairs").alias("pair")).join(scores, "pair") \
        .select("block", "pair", "n", "best")
    out = f"id {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, " \
        "groups_sha256 string"

    def score(scored: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        row = held.iloc[0]
        n_docs = len(row["ids"])
        by_pair = scored.sort_values("pair")  # the order of the block's own pairs
        n, best = by_pair["n"].to_numpy(np.int64), by_pair["best"].to_numpy(np.int64)
        n_links, n_best, count_sum = (np.zeros(n_docs, np.int64) for _ in range(3))
        for k, plane in enumerate(row["planes"]):
            pair, place = unpack(plane)
            np.add.at(n_links, place, 1 << k)
            np.add.at(n_best, place, best[pair] << k)
            np.add.at(count_sum, place, n[pair] << k)
        return pd.DataFrame({"id": pd.Series(list(row["ids"]), dtype="Int64" if kind.typeName() in
                                             ("long", "integer", "short", "byte") else object),
                             **{c: row[c] for c in longs}, "n_links": n_links, "n_best": n_best,
                             "count_sum": count_sum, "groups_sha256": row["groups_sha256"]})

    # The index is read again, as a table apart from the one inside ``back``.
    planes = spark.read.schema(index.schema).parquet(index._scratch_path) \
        .select("block", "ids", *longs, "groups_sha256", "planes")
    done = back.groupBy("block").cogroup(planes.groupBy("block")).applyInPandas(score, out)
    return done.withColumnRenamed("id", id_col)
