"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

Tokens are words (ASCII white space between, A-Z lower-cased) and one end per
text. The vocabulary grows with the input: the most frequent training tokens, as
many as half the square root of all training tokens (VOCABULARY at least); every
other token, seen or not, belongs to one more class. Classes are nested: a tree
of WIDTH outcomes a node, built from the counts so that frequent tokens lie near
its root (WIDTH-ary Huffman). The probability of a token is the product of the
outcomes on its path given the words before it, and for the class of the others
also (c + 1) / (N' + V' + 1) among its tokens, so that the whole sums to 1. Each
node's softmax starts from the counts and adds weights of hashed features: the
previous word, the pair of previous words, and the word before the previous one
(a skip). The root has a table of rows of its own, all other nodes share one.

Training runs in ROUNDS rounds over disjoint halves of the training documents.
In a round every task starts from the same weights and takes gradient steps on
mini-batches of its documents (Adagrad by row); a task has TASK_BYTES of text or
more, where there are more tasks than cores. The tasks' weights are then averaged, row by row by the number of steps that touched the row, in a tree of
at most FAN per group. Scoring is sparse: a batch gathers only its own rows.

Counts are exact and distributed. Vocabulary tokens are counted where they
stand. The others travel as packed (token hash, document, number) arrays to the
bucket of their hash, which counts them, a range of hashes after the other; the
documents' sums of log10(c + 1) return packed as well and are added up for each
document. The arrays are of PIECE pairs at most and reach a task BATCH_BYTES at a
time, so that a bucket is whole in its task alone, once and packed. Only the vocabulary
(about 100 bytes a token, for half the square root of the corpus), the weights (of
fixed size) and totals reach the driver. Which tokens make up the vocabulary is
decided by sums over the chunks of a task in which a token occurs OFTEN times or
more; what they count is exact. Tokens are known by 64-bit hashes.

Defined results: null text is the end alone; a row with null id is learned
from; rows that are equal in id and text get equal results; without training
documents both scores are 0. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import GOLD, Scratch, hashes_of, mix, prepare, word_hashes

VOCABULARY = 992  # tokens at least
WIDTH = 32
OFTEN = 4  # in a chunk of CHUNK tokens; in proportion in a smaller one
ROWS = 1 << 16  # hashed rows of weights, for the root and for all other nodes
SHIFT = np.uint64(64 - 16)
LOW, MASK = np.uint64(32), np.uint64((1 << 32) - 1)
ROUNDS = 2
STEP = 4096  # tokens of a gradient step
RATE = 0.25
BLOCK = 1024  # rows of WIDTH worked on at a time, so that they stay in the cache
LAYERS = 8  # occurrences of a row in a gradient step that are added one by one
FAN = 32
CHUNK = 1 << 21  # tokens counted at a time in a task
BUCKET_BYTES = 32 << 20  # of text for each bucket of tokens
PAIRS = 1 << 18  # (token, document) worked on at a time
PIECE = 1 << 13  # of them in one row
BATCH_BYTES = 2 << 20  # of such rows that Spark and its Python workers hand over at a time
TASK_BYTES = 16 << 20  # of text for each training task at least, as each leaves weights of fixed size
BLOCK_ROWS = 2048  # rows of weights in one row of the tree
END = np.uint64(0xE0D0E0D0E0D0E0D1)
START = np.uint64(0x57A9757A9757A971)
ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def tokens(text: bytes | None) -> np.ndarray:
    return np.append(word_hashes(text), END)


def tokens_of(texts):
    """``tokens`` of each text in turn."""
    for h in hashes_of(texts):
        yield np.append(h, END)


class Places:
    """The places of some tokens, by their hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.argsort(hashes)
        self.keys = hashes[self.sorted]

    def place(self, h: np.ndarray) -> np.ndarray:
        """The place of each token, or -1."""
        if not len(self.keys):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.sorted[at], -1)


class Vocabulary(Places):
    """The tokens of the vocabulary and the tree of classes over them and the
    others (which have the last place)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, others: int):
        super().__init__(hashes)
        self.hashes, self.counts = hashes, counts
        masses = np.append(counts, others) + 1.0
        # Merge the WIDTH lightest, again and again; the root is made last. The
        # first merge takes as few as make all later ones full.
        heap = [(m, i) for i, m in enumerate(masses.tolist())]
        heapq.heapify(heap)
        children, take = [], (len(heap) - 2) % (WIDTH - 1) + 2 if len(heap) > 1 else 1
        while len(heap) > 1 or not children:
            kids = [heapq.heappop(heap) for _ in range(min(take, len(heap)))]
            heapq.heappush(heap, (sum(m for m, _ in kids), len(masses) + len(children)))
            children.append(kids)
            take = WIDTH
        n = len(children)
        self.bias = np.full((n, WIDTH), -np.inf, np.float32)
        up, branch = np.full(len(masses) + n, -1), np.zeros(len(masses) + n, np.int64)
        for k, kids in enumerate(children):  # nodes are numbered from the root on
            whole = sum(m for m, _ in kids)
            for j, (m, child) in enumerate(kids):
                up[child], branch[child] = n - 1 - k, j
                self.bias[n - 1 - k, j] = np.log(m / whole)
        steps, at = [], np.arange(len(masses))
        while (at >= 0).any():  # from the leaves up
            parent = np.where(at >= 0, up[at], -1)
            steps.append((parent, branch[at]))
            at = np.where(parent >= 0, len(masses) + n - 1 - parent, -1)
            at = np.where(parent == 0, -1, at)
        self.length = sum((p >= 0).astype(np.int64) for p, _ in steps)
        depth = int(self.length.max())
        self.node, self.branch = np.zeros((2, depth, len(masses)), np.int32)
        for i, (p, j) in enumerate(steps):
            has = np.flatnonzero(p >= 0)
            self.node[self.length[has] - 1 - i, has] = p[has]
            self.branch[self.length[has] - 1 - i, has] = j[has]


def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts, and for each the one before and before that."""
    h = np.concatenate(texts)
    before = np.empty_like(h)
    before[1:] = h[:-1]
    ends = np.cumsum([len(t) for t in texts])
    starts = np.append(0, ends[:-1])
    before[starts] = START
    skip = np.empty_like(h)
    skip[1:] = before[:-1]
    skip[starts] = START
    return h, before, skip


def _row_max(x: np.ndarray) -> np.ndarray:
    """The largest of each row, as a column."""
    return np.maximum.reduce(np.ascontiguousarray(x.T), axis=0)[:, None]


class Model:
    """Weights of the two softmaxes over hashed rows."""

    def __init__(self, vocabulary: Vocabulary, weights: np.ndarray | None = None):
        self.v = vocabulary
        # weights[0] for the root, weights[1] for all other nodes
        self.w = np.zeros((2, ROWS, WIDTH), np.float32) if weights is None else weights.astype(np.float32)
        self.square = np.full((2, ROWS), 1.0, np.float32)
        self.steps = np.zeros((2, ROWS), np.float32)
        self.spare = np.empty((3, BLOCK, WIDTH), np.float32)

    @staticmethod
    def rows(before: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Hashes of the three features of each token: (tokens, 3)."""
        return np.stack([mix(before + ODD[0]), mix(before * ODD[1] + skip * ODD[2]), mix(skip + ODD[3])], 1)

    def _softmax(self, table: int, rows: np.ndarray, node: np.ndarray | None, truth: np.ndarray):
        """The log probability of the true outcome of WIDTH at each token's node
        (None: the root; the bias is -inf where there is no outcome), and what
        the gradient is made of: all exponentials, their sums. BLOCK tokens at
        a time stay in the cache."""
        w, biases = self.w[table], self.v.bias
        e, own, total = np.empty((len(rows), WIDTH), np.float32), np.empty(len(rows), np.float32), np.empty(len(rows), np.float32)
        ones = np.ones(WIDTH, np.float32)
        for a in range(0, len(rows), BLOCK):
            x, row, true = e[a:a + BLOCK], rows[a:a + BLOCK], truth[a:a + BLOCK]
            spare = self.spare[0, :len(x)]
            np.take(w, row[:, 0], axis=0, mode="clip", out=x)
            for k in (1, 2):
                x += np.take(w, row[:, k], axis=0, mode="clip", out=spare)
            x += biases[0] if node is None else np.take(biases, node[a:a + BLOCK], axis=0, mode="clip", out=spare)
            x -= _row_max(x)
            own[a:a + BLOCK] = x[np.arange(len(x)), true]
            total[a:a + BLOCK] = np.exp(x, out=x) @ ones
        return own - np.log(total), e, total

    def _learn(self, table: int, rows: np.ndarray, e: np.ndarray, total: np.ndarray, truth: np.ndarray):
        e *= (1 / total)[:, None]
        e[np.arange(len(e)), truth] -= 1
        flat = rows.astype(np.uint16).ravel()
        order = np.argsort(flat, kind="stable")
        key, of = flat[order], order // 3
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.diff(np.append(first, len(key)))
        # Rows that occur often come first, so that those with a k-th occurrence are the first so many.
        by = np.argsort((LAYERS + 1 - np.minimum(n, LAYERS + 1)).astype(np.uint8), kind="stable")
        first, n = first[by], n[by]
        at, square = key[first].astype(np.int64), self.square[table]
        w = self.w[table].reshape(-1).view(np.dtype((np.void, 4 * WIDTH)))  # whole rows
        for a in range(0, len(at), BLOCK):
            f, m, mine = first[a:a + BLOCK], n[a:a + BLOCK], at[a:a + BLOCK]
            grad, spare, rest = self.spare[:, :len(f)]
            np.take(e, of[f], axis=0, mode="clip", out=grad)
            many, two = int(np.count_nonzero(m > LAYERS)), int(np.count_nonzero(m > 1))
            np.take(e, of[f[many:two] + 1], axis=0, mode="clip", out=rest[many:two])
            for k in range(2, LAYERS):
                live = int(np.count_nonzero(m > k))
                if live == many:
                    break
                rest[many:live] += np.take(e, of[f[many:live] + k], axis=0, mode="clip", out=spare[many:live])
            grad[many:two] += rest[many:two]
            if many:
                starts = np.append(0, np.cumsum(m[:many])[:-1])
                each = np.repeat(f[:many] - starts, m[:many]) + np.arange(m[:many].sum())
                grad[:many] = np.add.reduceat(np.take(e, of[each], axis=0, mode="clip"), starts, axis=0)
            squares = square[mine] + np.einsum("ij,ij->i", grad, grad) / WIDTH
            square[mine] = squares
            grad *= (RATE / np.sqrt(squares))[:, None]
            new = spare.reshape(-1).view(w.dtype)
            np.take(w, mine, mode="clip", out=new)
            spare -= grad
            w[mine] = new
        self.steps[table, at] += n

    def log10(self, h: np.ndarray, before: np.ndarray, skip: np.ndarray, learn: bool = False):
        """log10 of the outcomes on each token's path, and the tokens' places."""
        v = self.v
        place = v.place(h)
        leaf = np.where(place >= 0, place, len(v.hashes))
        out = np.zeros(len(h))
        for a in range(0, len(h), STEP):
            part = leaf[a:a + STEP]
            hashes = self.rows(before[a:a + STEP], skip[a:a + STEP])
            live = np.arange(len(part))
            for d in range(len(v.node)):
                if d:
                    live = live[v.length[part[live]] > d]
                    if not len(live):
                        break
                node, branch = v.node[d, part[live]], v.branch[d, part[live]]
                own = mix(hashes[live] + (node.astype(np.uint64) * GOLD)[:, None]) if d else hashes
                rows = (own >> SHIFT).astype(np.int64)
                log_p, e, total = self._softmax(min(d, 1), rows, node if d else None, branch)
                out[a + live] += log_p
                if learn:
                    self._learn(min(d, 1), rows, e, total, branch)
        return out / np.log(10), place


def _local_counts(batches):
    """(token, n) of tokens frequent in a chunk of a task's texts, and (START, n)
    for all of its tokens."""
    held, size = [], 0

    def flush():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        often = n * CHUNK >= OFTEN * size
        h, n = np.append(h[often], START), np.append(n[often], size)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
    for batch in batches:
        for t in tokens_of(batch.column(0).to_pylist()):
            held.append(t)
            size += len(t)
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def row_key(doc_id: str | None, text: bytes | None) -> int:
    """Names a row by its id and text."""
    return xxhash.xxh3_64_intdigest(text or b"", seed=xxhash.xxh32_intdigest(doc_id or "\0"))


def _scatter(hashes: np.ndarray, buckets: int):
    """Rows (bucket, body) of the tokens outside the vocabulary, packed, and
    one row (-1, counts of the vocabulary in training texts)."""
    vocabulary = Places(hashes)

    def batch_of(found, bodies):
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(bodies, pa.binary())],
                                          names=["bucket", "body"])

    def run(batches):
        counts = np.zeros(len(hashes), np.int64)
        held, size = [], 0

        def flush():
            h = np.concatenate([x[0] for x in held])
            n = np.concatenate([x[1] for x in held])
            key = np.concatenate([np.full(len(x[0]), x[2], np.uint64) for x in held])
            train = np.concatenate([np.full(len(x[0]), x[3], np.uint32) for x in held])
            bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            bucket, h, n, key = bucket[order], h[order], (n.astype(np.uint32) * 2 + train)[order], key[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            found, bodies, large = [], [], 0
            for a, b in zip(first, np.append(first[1:], len(bucket)).astype(int)):
                for i in range(a, b, PIECE):
                    j = min(i + PIECE, b)
                    docs, at = np.unique(key[i:j], return_inverse=True)
                    found.append(int(bucket[a]))
                    bodies.append(np.int64(len(docs)).tobytes() + np.int64(j - i).tobytes() + docs.tobytes()
                                  + h[i:j].tobytes() + at.astype(np.uint32).tobytes() + n[i:j].tobytes())
                    large += len(bodies[-1])
                    if large >= BATCH_BYTES:
                        yield batch_of(found, bodies)
                        found, bodies, large = [], [], 0
            if found:
                yield batch_of(found, bodies)
        for batch in batches:
            doc_ids, trains, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, train, text, t in zip(doc_ids, trains, texts, tokens_of(texts)):
                h, n = np.unique(t, return_counts=True)
                place = vocabulary.place(h)
                if train:
                    counts[place[place >= 0]] += n[place >= 0]
                rest = place < 0
                held.append((h[rest], n[rest], row_key(doc_id, text), train))
                size += int(rest.sum())
                if size >= 2 * PAIRS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()
        yield batch_of([-1], [counts.tobytes()])
    return run


def unpack(body: bytes):
    docs, pairs = np.frombuffer(body, np.int64, 2)
    at = 16
    key = np.frombuffer(body, np.uint64, docs, at)
    at += 8 * docs
    h = np.frombuffer(body, np.uint64, pairs, at)
    at += 8 * pairs
    owner = np.frombuffer(body, np.uint32, pairs, at)
    at += 4 * pairs
    n = np.frombuffer(body, np.uint32, pairs, at)
    return key, h, owner, n >> 1, (n & 1).astype(bool)


def _merged(bodies: list[bytes]):
    """Some bodies as one: arrays as of ``unpack``."""
    found = [unpack(b) for b in bodies]
    base = np.cumsum([0] + [len(p[0]) for p in found])
    key, h, owner, n, train = zip(*found)
    owner = [x + np.uint32(b) for x, b in zip(owner, base)]
    return tuple(np.concatenate(x) for x in (key, h, owner, n, train))


def _by_range(block, parts: int, ranges: int):
    """A block of a bucket of ``parts``, its pairs in ``ranges`` of the bucket's
    hashes, else in their order; and the bounds of the ranges."""
    key, h, owner, n, train = block
    at = ((((h >> LOW) * np.uint64(parts)) & MASK) * np.uint64(ranges) >> LOW).astype(np.uint32)
    order = np.argsort(at, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(at, minlength=ranges)))
    return key, h[order], owner[order], n[order], train[order], ends


def _tally(parts: int):
    """Rows (part, body, place, tokens, kinds): for each of ``parts`` groups of
    documents their sums of log10(c + 1) and tokens with c > 0, packed; for a
    bucket (part and place null) its training tokens and distinct ones; for
    places of the vocabulary their tokens."""
    schema = pa.schema([("part", pa.int32()), ("body", pa.binary()), ("place", pa.int64()),
                        ("tokens", pa.int64()), ("kinds", pa.int64())])

    def finish(blocks):
        # Ranges of the bucket's hashes, in turn: each block's pairs range by range.
        ranges = -(-sum(len(b[1]) for b in blocks) // PAIRS)
        for i, b in enumerate(blocks):
            blocks[i] = _by_range(b, parts, ranges)
        base = np.cumsum([0] + [len(b[0]) for b in blocks])
        logs, known, tokens, kinds = np.zeros(base[-1]), np.zeros(base[-1], np.int64), 0, 0
        for k in range(ranges):
            mine = [[x[b[5][k]:b[5][k + 1]] for x in b[1:5]] for b in blocks]
            h = np.concatenate([x[0] for x in mine])
            owner = np.concatenate([x[1].astype(np.int64) + a for x, a in zip(mine, base)])
            n = np.concatenate([x[2] for x in mine]).astype(np.int64)
            train = np.concatenate([x[3] for x in mine])
            _, token = np.unique(h, return_inverse=True)
            c = np.bincount(token, np.where(train, n, 0))
            count = c[token]
            np.add.at(logs, owner, n * np.log10(count + 1))
            np.add.at(known, owner, np.where(count > 0, n, 0))
            tokens, kinds = tokens + int(c.sum()), kinds + int((c > 0).sum())
        key = np.concatenate([b[0] for b in blocks])
        part = ((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part, key, logs, known = part[order], key[order], logs[order], known[order]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else []
        for a, b in zip(first, np.append(first[1:], len(part)).astype(int)):
            yield {"part": int(part[a]), "body": key[a:b].tobytes() + logs[a:b].tobytes() + known[a:b].tobytes()}
        yield {"tokens": tokens, "kinds": kinds}

    def run(batches):
        bucket, blocks, bodies, size = None, [], [], 0
        for batch in batches:
            for b, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b == -1:
                    counts = np.frombuffer(body, np.int64)
                    yield pa.RecordBatch.from_pylist(
                        [{"place": i, "tokens": int(n)} for i, n in enumerate(counts)], schema)
                    continue
                if bodies and (b != bucket or size >= PAIRS):
                    blocks.append(_merged(bodies))
                    bodies, size = [], 0
                if b != bucket and blocks:
                    yield pa.RecordBatch.from_pylist(list(finish(blocks)), schema)
                    blocks = []
                bucket = b
                bodies.append(body)
                size += int(np.frombuffer(body, np.int64, 1, 8)[0])
        if bodies:
            yield pa.RecordBatch.from_pylist(list(finish([*blocks, _merged(bodies)])), schema)
    return run


def _sums(batches):
    """(key, logs, known) of the documents of each part, over all buckets."""
    def finish(bodies):
        cols = [np.frombuffer(b, np.uint64).reshape(3, -1) for b in bodies]
        key, at = np.unique(np.concatenate([c[0] for c in cols]), return_inverse=True)
        logs = np.bincount(at, np.concatenate([c[1].view(np.float64) for c in cols]))
        known = np.bincount(at, np.concatenate([c[2].view(np.int64) for c in cols])).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(logs), pa.array(known)],
                                          names=["key", "logs", "known"])
    part, bodies = None, []
    for batch in batches:
        for p, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != part and bodies:
                yield finish(bodies)
                bodies = []
            part = p
            bodies.append(body)
    if bodies:
        yield finish(bodies)


def _batched(batches, column: int):
    """Texts as token arrays, some STEPs of tokens together, with their rows."""
    held, rows, size = [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row, t in zip(zip(*columns), tokens_of(columns[column])):
            held.append(t)
            rows.append(row)
            size += len(held[-1])
            if size >= 4 * STEP:
                yield held, rows
                held, rows, size = [], [], 0
    if held:
        yield held, rows


def _train(shared):
    def run(batches):
        vocabulary, weights = shared.value
        model = Model(vocabulary, weights)
        for texts, _ in _batched(batches, 0):
            model.log10(*contexts(texts), learn=True)
        block, body = [], []
        for table in range(2):
            for a in range(0, ROWS, BLOCK_ROWS):
                n = model.steps[table, a:a + BLOCK_ROWS]
                block.append(table * (ROWS // BLOCK_ROWS) + a // BLOCK_ROWS)
                body.append(n.astype(np.float32).tobytes()
                            + model.w[table, a:a + BLOCK_ROWS].astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(body, pa.binary())],
                                         names=["block", "body"])
    return run


def _unblock(body: bytes):
    n = np.frombuffer(body, np.float32, BLOCK_ROWS)
    return n, np.frombuffer(body, np.float16, BLOCK_ROWS * WIDTH, 4 * BLOCK_ROWS).reshape(-1, WIDTH).astype(np.float32)


def _average(pdf):
    import pandas as pd
    steps, total = np.zeros(BLOCK_ROWS, np.float64), np.zeros((BLOCK_ROWS, WIDTH), np.float64)
    for body in sorted(pdf["body"]):
        n, w = _unblock(body)
        steps += n
        total += n[:, None] * w
    mean = total / np.maximum(steps, 1)[:, None]
    body = steps.astype(np.float32).tobytes() + mean.astype(np.float16).tobytes()
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [pdf["part"].iloc[0]], "body": [body]})


def _mixed(scratch: Scratch, rows: DataFrame, old: np.ndarray) -> np.ndarray:
    """The tasks' weights averaged in a tree; untouched rows keep the old ones."""
    parts = scratch.table(rows.withColumn("part", F.spark_partition_id()), "weights")
    while True:
        many = (parts.agg(F.max("part")).first()[0] or 0) + 1
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        parts = scratch.table(parts.groupBy("block", "part").applyInPandas(
            _average, "block int, part int, body binary"), "weights")
        if many <= FAN:
            break
    new = old.copy()
    flat = new.reshape(-1, WIDTH)
    for r in parts.collect():  # one row for each block of weights
        n, w = _unblock(r["body"])
        a = r["block"] * BLOCK_ROWS
        flat[a:a + BLOCK_ROWS][n > 0] = w[n > 0]
    return new


def _score(shared):
    def run(batches):
        vocabulary, weights = shared.value
        model = Model(vocabulary, weights)
        logs = np.append(np.log10(vocabulary.counts + 1.0), 0.0)
        seen = np.append(vocabulary.counts > 0, False).astype(np.int64)
        for texts, rows in _batched(batches, 2):
            out, place = model.log10(*contexts(texts))
            first = np.cumsum([0] + [len(t) for t in texts[:-1]])
            add = lambda x: np.add.reduceat(x, first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_()),
                 pa.array(np.array([row_key(r[0], r[2]) for r in rows], np.uint64).view(np.int64)),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array(add((place < 0).astype(np.int64))),
                 pa.array(add(out)), pa.array(add(logs[place])), pa.array(add(seen[place]))],
                names=["doc", "held_out", "key", "n_tokens", "others", "model", "logs_top", "known_top"])
    return run


@contextmanager
def _small_batches(spark):
    """Arrow batches of BATCH_BYTES or so for Python, if the session sets no bytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    unset = spark.conf.get(key, None) is None
    if unset:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(key)


def held_out(id_col: str):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """One row per row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigrams) and score (the model), both log10 of the text's
    probability. Rows with crc32(id) mod 7 = 2 are held out of the training."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "maxent")
    rows = docs.select(F.col(id_col).cast("string").alias("doc"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("binary").alias("text"))
    taught = rows.where("not held_out")
    # The vocabulary: tokens frequent somewhere, by their sum, and the end.
    often = scratch.table(taught.select("text").mapInArrow(_local_counts, "h long, n long").groupBy("h")
                          .agg(F.sum("n").alias("n")), "often")
    whole = often.where(F.col("h") == int(START.view(np.int64))).agg(F.sum("n")).first()[0] or 0
    size = vocabulary or max(VOCABULARY, math.isqrt(whole) // 2)
    top = often.where(~F.col("h").isin(int(END.view(np.int64)), int(START.view(np.int64)))) \
        .orderBy(F.desc("n"), "h").limit(size - 1).collect()
    some = not taught.isEmpty()
    hashes = np.array([int(END)] * some + [r["h"] % (1 << 64) for r in top], np.uint64)
    # Exact counts.
    letters = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(1, -(-letters // BUCKET_BYTES)))
    packed = rows.select("doc", (~F.col("held_out")).alias("train"), "text") \
        .mapInArrow(_scatter(hashes, buckets), "bucket int, body binary")
    with _small_batches(spark):
        tally = scratch.table(
            packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_tally(buckets), "part int, body binary, place long, tokens long, kinds long"), "tally")
    counts = np.zeros(len(hashes), np.int64)
    for r in tally.where("place is not null").groupBy("place").agg(F.sum("tokens").alias("n")).collect():
        counts[r["place"]] = r["n"]  # one row for each token of the vocabulary
    others = tally.where("kinds is not null").agg(F.sum("tokens"), F.sum("kinds")).first()
    rest_tokens, rest_kinds = int(others[0] or 0), int(others[1] or 0)
    order = np.lexsort((hashes, -counts))
    hashes, counts = hashes[order], counts[order]
    n, kinds = int(counts.sum()) + rest_tokens, int((counts > 0).sum()) + rest_kinds
    vocab = Vocabulary(hashes, counts, rest_tokens)
    # Rounds of training over disjoint parts of the training documents. (Fewer tasks than
    # partitions where those are small: their weights would outweigh the input.)
    tasks = max(spark.sparkContext.defaultParallelism, -(-letters // TASK_BYTES))
    weights = np.zeros((2, ROWS, WIDTH), np.float32)
    half = F.pmod(F.xxhash64(F.lit(5), "doc", "text"), F.lit(rounds))
    for i in range(rounds if some else 0):
        shared = spark.sparkContext.broadcast((vocab, weights))
        steps = taught.where(half == i).select("text").coalesce(tasks).mapInArrow(_train(shared), "block int, body binary")
        weights = _mixed(scratch, steps, weights)
    shared = spark.sparkContext.broadcast((vocab, weights))
    scored = scratch.table(rows.mapInArrow(
        _score(shared), "doc string, held_out boolean, key long, n_tokens long, others long, "
                        "model double, logs_top double, known_top long"), "scored")
    sums = tally.where("part is not null").select("part", "body").repartition(buckets, "part") \
        .sortWithinPartitions("part").mapInArrow(_sums, "key long, logs double, known long")
    copies = scored.groupBy("key").agg(F.count("*").alias("copies"))
    logs = F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
    known = F.coalesce(F.expr("known div copies"), F.lit(0))
    kind = docs.schema[id_col].dataType
    return scored.join(copies, "key").join(sums, "key", "left").select(
        F.col("doc").cast(kind).alias(id_col), "held_out", "n_tokens", (F.col("known_top") + known).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs_top") + logs - F.col("n_tokens") * float(np.log10(n + kinds + 1))).alias("base_score"),
        (F.col("model") + logs - F.col("others") * float(np.log10(rest_tokens + rest_kinds + 1))).alias("score"))
