"""Token counts by a compiled finite-state transducer.

A byte-pair vocabulary (a ``.model`` file) is compiled into a deterministic
transducer over characters whose transitions carry the number of tokens that
a character adds. Two facts make it finite. The tokens of a text that end at a
token border are the tokens of the text up to there. And a row of tokens is
what the merges give exactly if every two neighbours are. So after a prefix it
is enough to know, for each suffix that some longer token may start with, the
last token before that suffix and its distance in tokens: that is the state.
Reading a character, exactly one token can end there, the one that stands
beside the token before it; its distance is the transition's count (0 or below
where a longer token replaces shorter ones). Two characters that no token
holds side by side lead to the state that the second one leads to from the
start, whatever came before.

States and transitions are made when first met and kept; the paths of whole
words from the start state are kept as single edges. Both tables are emptied
at a fixed size, so memory stays bounded and only time is lost.

A text is cut in chunks of a fixed length. A chunk's map of states is held as
the characters up to its first border (the only part that depends on the state
before), the tokens counted after it and the state at its end. Maps compose
associatively, so the chunks of long texts are dealt over tasks and composed
in a tree of groups of ``FAN`` neighbours: the up-sweep of a prefix scan, whose
last value is the text's count. Short texts are counted where they are read.

Results: a row per input row, repeated rows included; a null or empty text has
0 bytes and 0 tokens; an empty table gives no rows. Texts of any length are
counted whole. A stretch without any border (one letter a million times) stays
one piece through the tree and is read in one go. Other columns of the input
are not read, whatever their names. Vocabularies must be byte-pair ones with
byte fallback, a space put before the text and no other normalisation;
anything else is refused.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

#: Characters of a chunk, and neighbouring maps composed at a time.
CHUNK = 1 << 16
FAN = 64
#: Sizes at which a task empties its tables of transitions and of words.
TRANSITIONS, WORDS = 400_000, 500_000
#: Longest word that is kept as one edge.
WORD_CHARS = 64
LIMIT = 4096

SPACE = "▁"


def vocabulary(model: bytes) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, checked to be of the kind that the
    transducer covers."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain, fallback = [], 0
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            fallback += 1
        elif sp.is_unused(i):
            raise ValueError("vocabularies with unused pieces are not covered")
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            plain.append((sp.id_to_piece(i), sp.get_score(i)))
    probe = " \tＡÅ é  x　\n "
    if fallback != 256 or sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError("the model must fall back to bytes and leave texts as they are")
    return plain


class Transducer:
    """The transducer of a vocabulary. A state is a tuple of entries (trie
    node of a suffix, node of the last token before it, tokens from there to
    here, negative), longest suffix first; tokens are nodes of the trie."""

    START = ((0, 0, 0),)

    def __init__(self, pieces: list[tuple[str, float]]):
        self.score = dict(pieces)
        self.next: list[dict[str, int]] = [{}]
        self.text = [""]
        self.pairs = {a + b for p in self.score for a, b in zip(p, p[1:])}
        self.joins = {c for p in self.pairs for c in p}
        for p in [*sorted(self.joins), *self.score]:
            node = 0
            for c in p:
                node = self._child(node, c)
        self.own: dict[int, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.steps: dict[tuple, tuple] = {}
        self.words: dict[str, int] = {}
        letters = "".join(re.escape(c) for c in sorted(self.joins - {SPACE}))
        self.units = re.compile(f"{SPACE}*[{letters}]+|{SPACE}+|[^{letters}{SPACE}]" if letters else ".", re.DOTALL)

    def _child(self, node: int, c: str) -> int:
        at = self.next[node].get(c)
        if at is None:
            at = self.next[node][c] = len(self.next)
            self.next.append({})
            self.text.append(self.text[node] + c)
        return at

    def merge(self, text: str) -> list[str]:
        """The tokens of a short text: the best scored pair first, the leftmost
        of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, c: str) -> int:
        """Tokens of one character that stands alone."""
        return 1 if c in self.score else len(c.encode())

    def _is_token(self, node: int) -> bool:
        known = self.own.get(node)
        if known is None:
            t = self.text[node]
            known = self.own[node] = len(t) == 1 or t in self.score and self.merge(t) == [t]
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side."""
        if not left:
            return True
        known = self.fits.get((left, right))
        if known is None:
            a, b = self.text[left], self.text[right]
            known = a[-1] + b[0] not in self.pairs or self.merge(a + b) == [a, b]
            if len(self.fits) >= TRANSITIONS:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def _step(self, state: tuple, c: str) -> tuple[tuple, int]:
        if c not in self.joins:
            return self.START, self.weight(c)
        last = self.text[state[-1][1]]
        if last and last[-1] + c not in self.pairs and state is not self.START:
            return self.step(self.START, c)
        live, token, count = [], 0, 0
        for node, before, distance in state:
            at = self.next[node].get(c)
            if at is None:
                continue
            if not token and self._is_token(at) and self._fit(before, at):
                token, count = at, distance + (self.weight(c) if not node else 1)
            if self.next[at]:
                live.append((at, before, distance))
        return (*((n, b, d - count) for n, b, d in live), (0, token, 0)), count

    def step(self, state: tuple, c: str) -> tuple[tuple, int]:
        """The next state and the tokens counted on the way."""
        hit = self.steps.get((state, c))
        if hit is None:
            hit = self._step(state, c)
            if len(self.steps) >= TRANSITIONS:
                self.steps.clear()
            self.steps[state, c] = hit
        return hit

    def walk(self, state: tuple, text: str) -> tuple[tuple, int]:
        total = 0
        for c in text:
            state, n = self.step(state, c)
            total += n
        return state, total

    def word(self, unit: str) -> int:
        """Tokens of a unit between two borders, kept as one edge."""
        n = self.words.get(unit)
        if n is None:
            n = self.walk(self.START, unit)[1]
            if len(unit) <= WORD_CHARS:
                if len(self.words) >= WORDS:
                    self.words.clear()
                self.words[unit] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        known, word = self.words, self.word
        return sum([known[u] if u in known else word(u)
                    for u in self.units.findall(SPACE + text.replace(" ", SPACE))])

    def chunk_map(self, text: str, first: bool) -> tuple[str, bool, int, tuple]:
        """The state map of a chunk: (characters before its first border, whether
        it has one, tokens after that, state at the end)."""
        text = text.replace(" ", SPACE)
        units = self.units.findall(SPACE + text if first else text)
        head = "" if first or units[0] not in self.joins and len(units[0]) == 1 else units.pop(0)
        if not units:
            return head, False, 0, self.START
        state, n = self.walk(self.START, units[-1])
        return head, True, sum(map(self.word, units[:-1])) + n, state

    def compose(self, a: tuple, b: tuple) -> tuple[str, bool, int, tuple]:
        """The map of two neighbouring stretches."""
        if not a[1]:
            return a[0] + b[0], b[1], b[2], b[3]
        state, n = self.walk(a[3], b[0])
        return (a[0], True, a[2] + n + b[2], b[3]) if b[1] else (a[0], True, a[2] + n, state)


def _flat(state: tuple) -> list[int]:
    return [x for entry in state for x in entry]


def _entries(flat) -> tuple:
    it = [int(x) for x in flat]
    return tuple(zip(it[::3], it[1::3], it[2::3]))


_MAP = "digest string, chunk long, head string, closed boolean, tokens long, state array<int>"


def _cut(text: str, size: int):
    for i in range(0, len(text), size):
        yield text[i:i + size]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row. ``model_path`` is read
    on the driver; its vocabulary travels to the tasks."""
    spark = prepare(docs.sparkSession)
    with open(model_path, "rb") as f:
        pieces = spark.sparkContext.broadcast(vocabulary(f.read()))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk

    def short(batches):
        machine = Transducer(pieces.value)
        for b in batches:
            texts = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("n_bytes"),
                 pa.array([machine.count(t) for t in texts], pa.int64())], ["id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    kind = docs.schema[id_col].dataType.simpleString()
    counted = rows.where(~is_long).select("id", "text", size) \
        .mapInArrow(short, f"id {kind}, n_bytes long, n_tokens long")
    scratch = Scratch(spark, "tokens")
    long_rows = scratch.table(rows.where(is_long).select("id", size, F.sha2("text", 256).alias("digest"), "text"), "long")
    if not long_rows.isEmpty():
        totals = _long_counts(scratch, long_rows, pieces, chunk, fan)
        counted = counted.unionByName(long_rows.select("id", "n_bytes", "digest").join(totals, "digest")
                                      .select("id", "n_bytes", "n_tokens"))
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))


def _long_counts(scratch: Scratch, long_rows: DataFrame, pieces, chunk: int, fan: int) -> DataFrame:
    """(digest, n_tokens) of each different long text, by the tree of maps."""
    def cut(batches):
        for b in batches:
            for digest, text in zip(b.column("digest").to_pylist(), b.column("text").to_pylist()):
                for i, part in enumerate(_cut(text, chunk)):
                    yield pa.RecordBatch.from_pydict({"digest": [digest], "chunk": [i], "part": [part]})

    def maps(batches):
        machine = Transducer(pieces.value)
        for b in batches:
            for digest, i, part in zip(*(b.column(c).to_pylist() for c in ("digest", "chunk", "part"))):
                head, closed, n, state = machine.chunk_map(part, i == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest]), pa.array([i], pa.int64()), pa.array([head]), pa.array([closed]),
                     pa.array([n], pa.int64()), pa.array([_flat(state)], pa.list_(pa.int32()))],
                    ["digest", "chunk", "head", "closed", "tokens", "state"])

    kept: list[Transducer] = []  # one for all groups of a task

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        if not kept:
            kept.append(Transducer(pieces.value))
        machine = kept[0]
        g = group.sort_values("chunk")
        whole = None
        for head, closed, n, state in zip(g["head"], g["closed"], g["tokens"], g["state"]):
            one = (head, bool(closed), int(n), _entries(state))
            whole = one if whole is None else machine.compose(whole, one)
        return pd.DataFrame({"digest": [g["digest"].iloc[0]], "chunk": [int(g["up"].iloc[0])], "head": [whole[0]],
                             "closed": [whole[1]], "tokens": [whole[2]], "state": [_flat(whole[3])]})

    # Copies of a text are cut once; chunks are spread over tasks by their place.
    texts = long_rows.groupBy("digest").agg(F.first("text").alias("text"))
    parts = texts.mapInArrow(cut, "digest string, chunk long, part string").repartition("digest", "chunk")
    level = scratch.table(parts.mapInArrow(maps, _MAP), "maps")
    while (level.agg(F.max("chunk")).first()[0] or 0) > 0:
        up = level.withColumn("up", F.floor(F.col("chunk") / fan).cast("long"))
        level = scratch.table(up.groupBy("digest", "up").applyInPandas(fold, _MAP), "composed")
    return level.select("digest", F.col("tokens").alias("n_tokens"))


def model_digest(path: str) -> str:
    """Which vocabulary a count was made with."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()
