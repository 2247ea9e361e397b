"""Text operators against brute force on small fixtures."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metricfold.llm import common, langid, linededup, maxent, minhash, mixing, segments, wumanber

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bands string, Line string"


def prose(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def corpus(seed=3):
    """Copies, near copies, shared passages, edited lines, blanks and nulls."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(20, 80)) for _ in range(12)]
    passage = prose(rng, 60)
    rows = []
    for i in range(60):
        words = base[rng.randrange(12)].split() if i % 3 else prose(rng, rng.randint(1, 40)).split()
        for _ in range(rng.choice((0, 0, 1, 2))):
            words[rng.randrange(len(words))] = prose(rng, 1)
        if i % 10 == 7:
            at = rng.randrange(len(words))
            words[at:at] = passage.split()
        text = " ".join(words)
        if i % 4 == 1:
            text = text.replace(" ", "\n", 2) + "\nA shared line of boilerplate here."
        if i % 8 == 5:
            text += "\nA shared line of boilerplete here."
        rows.append((i, text, "xy"[i % 2], ["s1", "s2", None, "é"][i % 4], len(text), "b", "l"))
    rows += [(60, None, None, None, None, None, None), (61, "", "x", "s1", 0, None, None),
             (62, " \n\t\n", "y", "s2", 4, None, None), (63, "one", "x", "s1", 3, None, None),
             (5, rows[5][1], "x", "s2", 1, None, None), (64, "É  ß\x85ñ \x0b z " * 3, "x", "tiny", 9, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_ws(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


# --- MinHash ------------------------------------------------------------------

def brute_components(sets, linked):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_minhash_brute_force(docs):
    sets = {}
    for i, text, *_ in corpus():
        w = words_ws(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    want = brute_components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b))
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(corpus())
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == \
        {(i, len(sets[i]), want[i], want[i] == i) for i in sets}


def test_minhash_edges(spark, empty):
    assert minhash.near_duplicates(empty).collect() == []
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "x"), (2, "y"), (3, "y"), (4, "Y\n")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got) == \
        [(-1, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (2, 2, True), (3, 2, False), (4, 2, False)]


def test_minhash_crowd_of_unlinked_copies(spark):
    """Copies that resemble a base but not one another keep linear work and no false link."""
    rng = random.Random(1)
    base = prose(rng, 120).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 80):
        w = list(base)
        for _ in range(2 if i % 2 else 7):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    want = brute_components(sets, lambda a, b: 100 * len(a & b) >= 75 * len(a | b))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_sketch_fills_and_concentrates():
    rng = np.random.default_rng(2)
    for n in (1, 3, 40, 900):
        items = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        other = np.unique(np.concatenate([items, rng.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
        a, b = minhash.sketch(items), minhash.sketch(other)
        share, true = (a == b).mean(), len(items) / len(other)
        assert abs(share - true) < 6 * (true * (1 - true) / minhash.BINS) ** 0.5 + 1e-9


# --- Wu-Manber ----------------------------------------------------------------

def words_alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(text, items):
    w = words_alnum(text)
    hit, names = set(), set()
    for item, body in items:
        b = words_alnum(body)
        m = min(13, len(b))
        wins = {tuple(b[i:i + m]) for i in range(len(b) - m + 1)} if m else set()
        for i in range(len(w) - m + 1 if m else 0):
            if tuple(w[i:i + m]) in wins:
                hit |= set(range(i, i + m))
                names.add(str(item))
    digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)


ITEMS = [(1, "a b"), (2, "a B c d e f g h i j k l m n o p"), (10, "one"), (11, None), (12, "?!"), (None, "a b"),
         (3, "c d e f g h i j k l m n o"), (4, "é ß ñ"), (2, "a B c d e f g h i j k l m n o p")]
TEXTS = [(1, "x a b x c d e f g h i j k l m n o p q"), (2, None), (3, ""), (4, "a-b ONE é.ß ñ"), (5, "a a b a b b"),
         (6, "z " * 500 + "a b c d e f g h i j k l m n o p"), (1, "x a b"), (None, "one")]


@pytest.mark.parametrize("block", [wumanber.BLOCK_WORDS, 4])
def test_wumanber_brute_force(spark, block):
    d = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id long, text string, items string")
    b = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = wumanber.contamination(d, b, block_words=block).collect()
    known = [x for x in ITEMS if x[0] is not None]
    want = [(i, *brute_contamination(t, known)) for i, t in TEXTS]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_wumanber_random(spark):
    rng = random.Random(8)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice((1, 2, 5, 13, 14, 20)))) for i in range(12)]
    texts = [(i, text(rng.randint(0, 400))) for i in range(40)]
    got = wumanber.contamination(spark.createDataFrame(texts, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(i, *brute_contamination(t, items)) for i, t in texts}


def test_wumanber_empty(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert wumanber.contamination(empty, none).collect() == []
    d = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert tuple(wumanber.contamination(d, none).first()) == (1, 1, 0, 0, wumanber.EMPTY_SHA256, False)


# --- Segments -----------------------------------------------------------------

def test_segments_find_passages_inside_lines(docs, spark):
    rng = random.Random(4)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, rng.randint(20, 50)) + " " + (passage + " " if i % 3 == 0 else "") + prose(rng, 30))
            for i in range(30)]
    got = segments.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {i for i in range(30) if i % 3 == 0 and i}
    texts = dict(rows)
    for r in got:
        assert r.first_doc == 0 and texts[r.doc_id][r.start:r.stop].strip() in passage
        assert r.n_words >= 25


def test_segments_brute_force(docs, empty):
    rows, seen, want = corpus(), {}, set()
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        for a, b, n, d1, d2 in zip(*segments.units(text.encode() if text else None)):
            assert len(words_ws(text[a:b])) == n
            first = seen.setdefault((d1, d2), (i, a))
            if first != (i, a):
                want.add((i, a, b, n, *first))
    got = {tuple(r) for r in segments.repeated_units(docs).collect()}
    assert got == {tuple(int(x) for x in w) for w in want}
    clean = {r.doc_id: r.text for r in segments.remove_repeats(docs).collect()}
    for i, text, *_ in rows:
        cuts = sorted({(w[1], w[2]) for w in want if w[0] == i})
        out, at = "", 0
        for a, b in cuts:
            out, at = out + text[at:a], b
        assert clean[i] == (text if not cuts else out + text[at:])
    assert segments.repeated_spans(empty).collect() == []


def brute_spans(rows):
    """Runs of words that lie in a gram with an earlier occurrence."""
    k, seen, out = segments.MIN_WORDS, {}, []
    for i, text in sorted(rows):
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        w = words_ws(text)
        hit = set()
        for a in range(len(w) - k + 1):
            if seen.setdefault(tuple(w[a:a + k]), (i, a)) != (i, a):
                hit |= set(range(a, a + k))
        for a in sorted(hit):
            if a - 1 not in hit:
                b = next(b for b in range(a, len(w) + 1) if b not in hit)
                out.append((i, spans[a][0], spans[b - 1][1], b - a))
    return out


@pytest.mark.parametrize("ends", [" ", "\n"])
def test_segments_are_exact_to_the_word(spark, ends):
    """Passages of REACH words and more are found whole, also in lines of a few words."""
    rng = random.Random(14)
    broken = lambda w: "".join(x + (ends if n % 4 == 3 else " ") for n, x in enumerate(w))
    passages = [prose(rng, n).split() for n in (segments.REACH, 30, 51, 60, 120)]
    rows = []
    for i in range(80):
        words = prose(rng, rng.randint(0, 60)).split() + [f"ß{i}"] + passages[i % 5] + [f"é{i}"] + prose(rng, 20).split()
        rows.append((i, broken(words)))
    want = brute_spans(rows)
    assert len(want) == 75 and {w[3] for w in want} >= {segments.REACH, 30, 51, 60, 120}
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = segments.repeated_spans(d).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.n_words) for r in got) == want
    assert all(r.first_doc == r.doc_id % 5 for r in got)
    clean = {r.doc_id: r.text for r in segments.remove_spans(d).collect()}
    for i, text in rows:
        a, b = next(((w[1], w[2]) for w in want if w[0] == i), (0, 0))
        assert clean[i] == text[:a] + text[b:]


def test_segments_copies_that_part(spark):
    """A copy may end, or begin, within what other copies share longer."""
    rng = random.Random(17)
    whole = prose(rng, 150).split()
    rows = []
    for i in range(60):
        a, n = rng.randrange(110), rng.randint(segments.REACH, 100)
        words = whole[a:a + n] if i > 1 else whole
        rows.append((i, " ".join([f"ß{i}", f"ü{i}"] + words + [f"é{i}"] + prose(rng, 20).split())))
    want = brute_spans(rows)
    got = segments.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.n_words) for r in got) == want


def test_segments_chance_word_at_an_end(spark):
    """A word that few of the copies go on with stays; two copies are compared to their ends."""
    a, b = prose(random.Random(15), 40), prose(random.Random(16), 40)
    rows = [(0, f"u0 {a} so v0"), (1, f"u1 {a} so v1"), *[(i, f"u{i} {a} no{i} v{i}") for i in (2, 5, 6)],
            (3, f"{b} so v3"), (4, f"u4 {b} so v4")]
    got = segments.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start, r.n_words, r.first_doc) for r in got) == \
        [(1, 3, 40, 0), (2, 3, 40, 0), (4, 3, 41, 3), (5, 3, 40, 0), (6, 3, 40, 0)]


def test_segments_repeated_rows_cost_one(spark, monkeypatch):
    """Rows with the same id and text are worked on once, however many there are."""
    sizes = []

    class Counting(segments.Scratch):
        def table(self, df, name):
            out = super().table(df, name)
            if name in ("anchors", "pieces"):
                sizes.append(out.count())
            return out
    monkeypatch.setattr(segments, "Scratch", Counting)
    rng = random.Random(21)
    text, other = prose(rng, 400), prose(rng, 60)
    results = []
    for copies in (1, 3, 300):
        rows = [(1, text + " a " + other)] * copies + [(2, f"b {other} c {text[:900]}")] * copies + [(3, "d " + other)]
        got = segments.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
        results.append(sorted(map(tuple, got.collect())))
    assert results[0] == results[1] == results[2] != []
    assert sizes[:2] == sizes[2:4] == sizes[4:6]


def shuffle_blocks(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_segments_disk_holds_one_pass(spark, monkeypatch):
    """A table's shuffles go when it is written; digests are grouped in passes of less than half of them."""
    left, ahead = [], []

    class Watching(segments.Scratch):
        def table(self, df, name):
            before = shuffle_blocks(spark)
            out = super().table(df, name)
            until = time.time() + 10
            while shuffle_blocks(spark) - before and time.time() < until:
                time.sleep(0.1)  # removed in the background
            left.append(len(shuffle_blocks(spark) - before))
            if name == "ahead":
                ahead.append({tuple(r) for r in out.select("d1", "d2").collect()})
            return out
    monkeypatch.setattr(segments, "Scratch", Watching)
    rng = random.Random(23)
    rows = [(i, f"u{i} " + prose(random.Random(i // 2), 80) + " " + prose(rng, 30)) for i in range(12)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.sparkContext._jvm.System.gc()  # what earlier tests left is not counted
    got = segments.repeated_spans(d).collect()
    assert sorted((r.doc_id, r.start, r.stop, r.n_words) for r in got) == brute_spans(rows)
    assert left and not any(left)
    whole = set().union(*ahead)
    assert sum(map(len, ahead)) == len(whole) and max(map(len, ahead)) < len(whole) / 2
    assert spark.conf.get(common.TIDY, None) is None


def test_segments_small_texts_are_hashed_together(monkeypatch):
    """A batch of small texts costs few calls, and gives what each text gives alone."""
    calls = []

    def counting(x):
        calls.append(len(x))
        return common_mix(x)
    common_mix = common.mix
    rng = random.Random(29)
    shared = prose(rng, 90).split()
    texts = [None, "", "a b", " \n ", " ".join(shared), "x " * 60]
    for i in range(200):
        a = rng.randrange(60)
        words = prose(rng, rng.randint(0, 9)).split() + shared[a:a + rng.randint(0, 50)] + [f"ß{i}"] * rng.randint(0, 12)
        texts.append("".join(w + rng.choice(" " * 9 + "\n") for w in words) if i % 9 else prose(rng, rng.randint(1, 40)))
    texts.append(prose(rng, 20_000) + " " + " ".join(shared))  # more than a block
    texts.append(" ".join(shared[5:]))
    encoded = [t if t is None else t.encode() for t in texts]

    def run(emit, batch):
        calls.clear()
        whole = pa.Table.from_batches(list(emit([batch]))).to_pylist()
        together = len(calls)
        alone = [r for i in range(batch.num_rows)
                 for found in emit([batch.slice(i, 1)]) for r in found.to_pylist()]
        order = lambda r: tuple(r.values())
        assert sorted(whole, key=order) == sorted(alone, key=order) != []
        assert together < batch.num_rows / 2
        return whole
    monkeypatch.setattr(segments, "mix", counting)
    keys = pa.array(range(len(texts)), pa.int64())
    found = run(segments._emit_anchors, pa.RecordBatch.from_arrays(
        [keys, pa.array(encoded, pa.binary())], names=["key", "text"]))
    copies, links = Counter(r["g"] for r in found), Counter(r["link"] for r in found)
    near = {}
    for r in found:
        if copies[r["g"]] > 1:
            near.setdefault(r["key"], []).insert(0, {"at": r["at"], "copies": copies[r["g"]], "links": links[r["link"]]})
    kind = pa.list_(pa.struct([("at", pa.int32()), ("copies", pa.int64()), ("links", pa.int64())]))
    ids = pa.array(sorted(near), pa.int64())
    got = run(segments._emit_pieces, pa.RecordBatch.from_arrays(
        [ids, ids, pa.array([encoded[i] for i in sorted(near)], pa.binary()),
         pa.array([near[i] for i in sorted(near)], kind)], names=["doc_id", "key", "text", "near"]))
    assert len({(r["key"], r["at"], r["words"]) for r in got}) == len(got)
    same = {}
    for r in got:  # offsets count characters; equal digests are equal words
        words = words_ws(texts[r["doc_id"]][r["start"]:r["stop"]])
        assert len(words) == r["words"]
        assert words_ws(texts[r["doc_id"]])[r["at"]:r["at"] + r["words"]] == words
        assert same.setdefault((r["d1"], r["d2"]), words) == words
    assert len(set(map(tuple, same.values()))) == len(same)


def test_segments_sort_once(spark, docs):
    """One sort serves the windows over the repeats, which are distinct as they come."""
    plan = segments.repeated_spans(docs)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Window ") >= 1 and plan.count("Sort [") == 1


def test_segments_spans_hold_the_units(docs):
    """What whole units find is in the spans."""
    spans = segments.repeated_spans(docs).collect()
    for u in segments.repeated_units(docs).collect():
        assert any(s.doc_id == u.doc_id and s.start <= u.start and u.stop <= s.stop for s in spans)


# --- Lines --------------------------------------------------------------------

def within_one(x, y):
    if abs(len(x) - len(y)) > 1:
        return False
    if len(x) > len(y):
        x, y = y, x
    i = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
    return x[i + 1:] == y[i + 1:] if len(x) == len(y) else x[i:] == y[i + 1:]


def brute_lines(rows):
    lines = []
    for i, text, *_ in rows:
        if text is not None and i is not None:
            lines += [(i, k, x.strip(linededup.SPACE).translate(LOWER)) for k, x in enumerate(text.split("\n"))]
    lines = sorted({x for x in lines if x[2]})
    long = lambda x: len(x) >= linededup.MIN_CHARS
    first = {}
    for i, k, x in lines:
        first.setdefault(x, (i, k))
    out = set()
    for i, k, x in lines:
        near = [r for y, r in first.items() if r < first[x] and long(x) and long(y) and within_one(x, y)]
        if near:
            out.add((i, k, *min(near), 1))
        elif first[x] != (i, k):
            out.add((i, k, *first[x], 0))
    return out


def test_lines_brute_force(docs, empty):
    assert {tuple(r) for r in linededup.repeated_lines(docs).collect()} == brute_lines(corpus())
    assert linededup.repeated_lines(empty).collect() == []


def test_lines_edits_everywhere(spark):
    rng = random.Random(6)
    rows = []
    for n in range(120):
        line = "".join(rng.choice("abé") for _ in range(rng.randint(14, 19)))
        for _ in range(3):
            at, kind = rng.randrange(len(line)), rng.randrange(3)
            new = rng.choice("abzß")
            rows.append((len(rows), {0: line[:at] + line[at + 1:], 1: line[:at] + new + line[at:],
                                     2: line[:at] + new + line[at + 1:]}[kind] + "\n" + line[::-1]))
    rows += [(1000, "q" * 5000), (1001, "q" * 4999), (1002, None), (1003, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    assert {tuple(r) for r in linededup.repeated_lines(d).collect()} == want
    clean = {r.doc_id: r.text for r in linededup.remove_lines(d).collect()}
    for i, text in rows:
        gone = {w[1] for w in want if w[0] == i}
        assert clean[i] == (None if text is None else "\n".join(
            x for k, x in enumerate(text.split("\n")) if k not in gone))


def test_lines_permuted_words(spark):
    """Lines of the same words in another order do not hide one another's partners."""
    line = lambda a, b, n: f"see {a} {b} list posted by the editorial staff {n}"
    rng = random.Random(12)
    rows = [(0, line("alpha", "beta", 1)), (1, line("beta", "alpha", 1)), (2, line("beta", "alpha", 2)),
            (3, line("alpha", "beta", 12)), (4, line("beta", "alpha", 12))]
    for i in range(5, 90):
        words = "abab baba bcbc cbcb acac caca".split()
        rng.shuffle(words)
        rows.append((i, f"of the {' '.join(words[:3])} and so on until the end {rng.choice(('', 'x', 'y', 'zz'))}."))
    want = brute_lines(rows)
    assert (2, 0, 1, 0, 1) in want and (4, 0, 1, 0, 1) in want
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in linededup.repeated_lines(d).collect()} == want


def test_lines_variant_keys_follow_the_order(spark):
    """A deletion's key is the key of the line without that character, and of no other line."""
    rng = random.Random(13)
    lines = {"".join(rng.choice("abé") for _ in range(rng.choice((3, 64, 65, 200)))) for _ in range(60)}
    lines |= {x[:i] + x[i + 1:] for x in lines for i in range(len(x))}
    lines = sorted(lines)
    d = spark.createDataFrame([(x,) for x in lines], "line string")
    got = d.select("line", F.inline(linededup._variants(F.split("line", "")))).collect()
    keys = {r.line: r.v for r in got if r.pos == 0}
    assert len(set(keys.values())) == len(lines) and len(got) == sum(len(x) + 1 for x in lines)
    for r in got:
        without = r.line[:r.pos - 1] + r.line[r.pos:]
        assert r.pos == 0 or keys.get(without, r.v) == r.v


# --- Mixing -------------------------------------------------------------------

def brute_mix(rows):
    sizes = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s, *_ in rows]
    names = sorted({s for _, s, _ in sizes if s is not None}) + [None] * any(s is None for _, s, _ in sizes)
    total = {s: sum(z for _, x, z in sizes if x == s) for s in names}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    capped = set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2.0 * total[s] for s in capped)
        free = [s for s in names if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * total[s]}
        if not over:
            return sizes, total, {s: 2.0 * total[s] if s in capped else weight[s] * level for s in names}
        capped |= over


def test_mixing_meets_targets(docs, empty):
    sizes, total, target = brute_mix(corpus())
    got = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.source or "", r.size) for r in got) == sorted((i, s or "", z) for i, s, z in sizes)
    taken = {}
    for r in got:
        assert r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    # Whole blocks, the last one cut at the target: within a few small blocks of it.
    assert all(int(target[s] + 1e-9) - 4 <= n <= int(target[s] + 1e-9) for s, n in taken.items())
    key = lambda r: (r.doc_id, r.source or "", r.size, r.taken)
    assert sorted(map(key, mixing.mix(docs.repartition(3)).collect())) == sorted(map(key, got))
    assert mixing.mix(empty).collect() == []


def test_mixing_schedule_interleaves(docs):
    sizes, targets, takes = mixing.schedule(docs, block=16)
    slots = takes.select("slot", "source").distinct().orderBy("slot").collect()
    share = {r.source: r.target for r in targets.collect()}
    whole = sum(share.values())
    for stop in (len(slots) // 3, len(slots) // 2, len(slots)):
        for s, t in share.items():
            if t:
                n = sum(r.source == s for r in slots[:stop])
                assert abs(n - stop * t / whole) <= 4
    bad = takes.where("from_word < 0 or to_word > size or from_word >= to_word").count()
    assert bad == 0
    by_slot = takes.groupBy("slot", "source").agg(F.sum(F.expr("to_word - from_word")).alias("n")).collect()
    short = Counter(r.source for r in by_slot if r.n < 16)
    assert all(r.n <= 16 for r in by_slot) and all(n == 1 for n in short.values())  # the last block of a source


def test_mixing_points_decide(docs):
    """Other points give other words: a step of 0 leaves all slots to one source."""
    def taken(**options):
        rows = mixing.mix(docs, block=16, **options).groupBy("source").agg(F.sum("taken"), F.max("target")).collect()
        return {r[0]: (r[1], r[2]) for r in rows}
    golden, zero, quarter = taken(), taken(step=0.0), taken(step=0.25)
    assert all(t - 2 * 16 <= n <= t for n, t in golden.values())
    assert golden != zero != quarter != golden
    first = min(golden, key=lambda s: (s is None, s or ""))
    assert zero[first] == golden[first] and all(n <= 16 for s, (n, _) in zero.items() if s != first)


# --- Language -----------------------------------------------------------------

VOICES = {"en": "the of and tion ing er th", "de": "der und sch ung keit ei", "fr": "le la ou eau tion é",
          "es": "el la ción os mente ñ"}


def voiced(rng, lang, n):
    parts = VOICES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)).title()


def test_langid_held_out_accuracy(spark):
    rng = random.Random(5)
    rows = [(i, voiced(rng, lang, rng.randint(4, 60)), lang) for i in range(800) for lang in [rng.choice(list(VOICES))]]
    hard = [(9001, None, "en"), (9002, "", "de"), (9003, "123 !?", "fr"), (9004, "12 é", None), (None, "the", "en")]
    d = spark.createDataFrame(rows + hard, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(d).collect()}
    for i in (9001, 9002, 9003):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[9004].lang_pred in VOICES and got[None].held_out is False
    out = [(lang, got[i]) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(r.held_out for _, r in out) and all(0 <= r.score <= 1 for _, r in out)
    assert sum(lang == r.lang_pred for lang, r in out) >= 0.95 * len(out)
    kept = {r.doc_id for r in langid.keep_identified(d).collect()}
    assert kept.isdisjoint({9001, 9002, 9003}) and len(kept & set(range(800))) >= 760


def brute_language_features(text):
    """Hashed 2- to 4-grams, gram by gram."""
    raw = list((text or "").encode())
    b = [x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in raw]
    for i in range(1, len(b)):
        if b[i - 1] == 0xC3 and 0x80 <= b[i] <= 0x9E and b[i] != 0x97:
            b[i] += 32
    b = [x for i, x in enumerate(b) if x != 32 or i == 0 or b[i - 1] != 32]
    if not any(c.isalpha() for c in text or ""):
        return None
    if len(b) < 2:
        b.append(32)
    odd, mask, counts = langid._ODD, 0xFFFFFFFF, Counter()
    for n in (2, 3, 4):
        for i in range(len(b) - n + 1):
            h = b[i] * odd[0] & mask
            for k in range(1, n):
                h = (h ^ h >> 15) * odd[k] + b[i + k] * odd[0] & mask
            counts[((h ^ h >> 13) * odd[3] & mask) >> 18] += 1
    size = sum(counts.values()) ** 0.5
    return {k: v ** 0.5 / size for k, v in counts.items()}


def brute_machine(plus, minus):
    """Dual coordinate descent over rows (key, features) of two sides, in the order of their keys."""
    rows = sorted([(k, x, 1) for k, x in plus] + [(k, x, -1) for k, x in minus], key=lambda r: r[0])
    w, bias, alpha, order = Counter(), 0.0, [0.0] * len(rows), np.random.default_rng(7)
    share = {1: len(rows) / (2 * max(1, len(plus))), -1: len(rows) / (2 * max(1, len(minus)))}
    for _ in range(langid.EPOCHS):
        for i in order.permutation(len(rows)):
            _, x, s = rows[i]
            margin = s * (sum(w[k] * v for k, v in x.items()) + bias) - 1
            new = min(max(alpha[i] - margin / 2, 0.0), langid.COST * share[s])
            for k, v in x.items():
                w[k] += (new - alpha[i]) * s * v
            bias += (new - alpha[i]) * s
            alpha[i] = new
    return lambda x: sum(w[k] * v for k, v in x.items()) + bias


def test_langid_brute_force(spark):
    """Families, machines, votes and scores of a small corpus, worked out one by one."""
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(["", "É ", "1 "])) + voiced(rng, lang, rng.randint(3, 30)), lang)
            for i, lang in ((i, rng.choice(list(VOICES))) for i in range(90))] + [(200, None, "en"), (201, "12 3", None), (202, "ü", None)]
    taught = [(str(i), brute_language_features(t), lang) for i, t, lang in rows
              if zlib.crc32(str(i).encode()) % 3 != 1 and lang and t]
    langs = sorted({lang for *_, lang in taught})
    mean = {}
    for lang in langs:
        total = Counter()
        for _, x, own in taught:
            if own == lang:
                total.update(x)
        size = sum(v * v for v in total.values()) ** 0.5
        mean[lang] = {k: v / size for k, v in total.items()}
    close = lambda a, b: sum(v * mean[b].get(k, 0.0) for k, v in mean[a].items())
    groups = [[x] for x in langs]
    while len(groups) > 2:
        a, b = max(((a, b) for a in groups for b in groups if a < b),
                   key=lambda p: np.mean([close(x, y) for x in p[0] for y in p[1]]))
        groups = sorted([sorted(a + b)] + [g for g in groups if g not in (a, b)])

    def machine(one, other):
        return brute_machine(*[[(k, x) for k, x, lang in taught if lang in side] for side in (one, other)])
    across, inside = machine(groups[0], groups[1]), {}
    for g in groups:
        for i, x in enumerate(g):
            for y in g[i + 1:]:
                inside[x, y] = machine([x], [y])
    sure = lambda m: 1 / (1 + np.exp(-4 * m))
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in rows:
        x = brute_language_features(t)
        if x is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        m = across(x)
        g, p = (groups[0], sure(m)) if m >= 0 else (groups[1], 1 - sure(m))
        votes, power, low = Counter(), Counter(), {y: 1.0 for y in g}
        for (a, b), f in inside.items():
            if a in g:
                m = f(x)
                votes[a if m >= 0 else b] += 1
                for y, sign in ((a, 1), (b, -1)):
                    power[y] += sign * m
                    low[y] = min(low[y], sure(sign * m))
        best = max(g, key=lambda y: (votes[y], power[y]))
        assert got[i].lang_pred == best and abs(got[i].score - min(1.0, p * low[best])) < 1e-2  # features are single precision there


def test_langid_families_are_learned():
    rng = np.random.default_rng(2)
    centre = rng.random((3, 40))
    means = {f"l{i}": np.concatenate([centre[i % 3] + rng.random(40) * 0.1, np.zeros(langid.DIM - 40)]) for i in range(9)}
    got = langid.group_families(means)
    assert {k: int(v[1:]) % 3 for k, v in got.items()} == {f"l{i}": i % 3 for i in range(9)}
    assert len(set(got.values())) == 3 and langid.group_families({}) == {}
    assert langid.group_families({"x": np.zeros(langid.DIM)}) == {"x": "x"}


def test_langid_edges(spark, empty):
    assert langid.identify(empty).collect() == []
    one = spark.createDataFrame([(2, "abc", "x"), (3, "\x00", "x")], "doc_id long, text string, lang string")
    assert {(r.doc_id, r.lang_pred) for r in langid.identify(one).collect()} <= {(2, "x"), (2, "und"), (3, "und")}
    none = spark.createDataFrame([(2, "abc", None)], "doc_id long, text string, lang string")
    assert langid.identify(none).first().lang_pred == "und"


# --- Language model -----------------------------------------------------------

def test_maxent_base_and_gain(spark):
    rng = random.Random(9)
    pairs = [("sun", "rises"), ("rain", "falls"), ("wind", "blows"), ("snow", "melts")]
    rows = [(i, " ".join(w for _ in range(rng.randint(1, 60)) for w in rng.choice(pairs))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "unseen Words here sun"), (None, "sun"), (7, rows[7][1]), (7, rows[7][1])]
    got = maxent.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = {}
    for i, t in rows:
        if not held(i):
            for w in words_ws(t) + ["\0end"]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = {}
    for i, t in rows:
        w = words_ws(t) + ["\0end"]
        want[i] = (held(i), len(w), sum(x in counts for x in w), n,
                   sum(np.log10((counts.get(x, 0) + 1) / (n + v + 1)) for x in w))
    for r in got:
        h, size, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, size, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    out = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)


def test_maxent_small_vocabulary_counts_others(spark):
    """Tokens outside the vocabulary are counted by bucket."""
    rng = random.Random(2)
    rows = [(i, prose(rng, 50, "ab")) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    small = {r.doc_id: r for r in maxent.score_texts(d, vocabulary=8).collect()}
    large = {r.doc_id: r for r in maxent.score_texts(d).collect()}
    for i in small:
        assert small[i].n_known == large[i].n_known
        assert abs(small[i].base_score - large[i].base_score) < 1e-6


def test_maxent_sums_to_one():
    h = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    v = maxent.Vocabulary(h, np.arange(60, 1, -1), 7)
    m = maxent.Model(v, np.random.default_rng(1).normal(size=(2, maxent.ROWS, maxent.WIDTH)))
    every = np.append(h, np.uint64(5))  # one of the others
    out, _ = m.log10(every, np.full(60, h[3]), np.full(60, h[9]))
    assert abs((10 ** out).sum() - 1) < 1e-4


def test_maxent_hashes_small_texts_together(monkeypatch):
    """Small texts share the calls that hash them; each gets its own tokens."""
    rng = random.Random(29)
    texts = [None, b"", b" ", b"\n", b"A b", b"x" * 70000 + b" Y", None, b"a\0b \xc3\xa9", b"z " * 31000, b""]
    texts += [prose(rng, 30).encode() for _ in range(400)]
    want = [maxent.tokens(t) for t in texts]
    calls, plain = [], common._hash_words

    def counted(*args):
        calls.append(1)
        return plain(*args)
    monkeypatch.setattr(common, "_hash_words", counted)
    got = list(maxent.tokens_of(texts))
    assert len(got) == len(want) and all(np.array_equal(a, b) for a, b in zip(got, want))
    assert len(calls) < 20
    assert list(maxent.tokens_of([])) == []


@pytest.mark.parametrize("scale", [0.0, 1.0, 30.0, 500.0])
def test_maxent_scores_with_weights_of_any_size(scale):
    """Exponentials neither overflow nor vanish, at the root or at given nodes, in whole blocks or parts."""
    rng = np.random.default_rng(30)
    h = maxent.mix(np.arange(1, 400, dtype=np.uint64))
    v = maxent.Vocabulary(h, np.arange(400, 1, -1), 11)
    m = maxent.Model(v, rng.normal(size=(2, maxent.ROWS, maxent.WIDTH)) * scale - scale)
    n = 3 * maxent.BLOCK + 5
    before, skip = rng.integers(0, 1 << 40, (2, n)).astype(np.uint64)
    rows = (m.rows(before, skip) >> maxent.SHIFT).astype(np.int64)
    node, truth = np.zeros(n, np.int32), rng.integers(0, maxent.WIDTH, n)
    truth = np.where(np.isfinite(v.bias[0][truth]), truth, int(np.argmax(v.bias[0])))
    x = (m.w[0][rows[:, 0]] + m.w[0][rows[:, 1]] + m.w[0][rows[:, 2]] + v.bias[0]).astype(np.float64)
    top = x.max(1, keepdims=True)
    want = x[np.arange(n), truth] - top[:, 0] - np.log(np.exp(x - top).sum(1))
    for at in (None, node):
        assert np.allclose(m._softmax(0, rows, at, truth)[0], want, rtol=1e-5, atol=1e-5)


def test_maxent_gradient_step_adds_repeated_rows():
    """Rows that occur once, twice, a few times and far more often in a step."""
    rng = np.random.default_rng(31)
    m = maxent.Model(maxent.Vocabulary(maxent.mix(np.arange(1, 80, dtype=np.uint64)), np.arange(80, 1, -1), 3),
                     rng.normal(size=(2, maxent.ROWS, maxent.WIDTH)))
    w, n = m.w[1].astype(np.float64), maxent.STEP
    rows = np.minimum(rng.zipf(1.3, (n, 3)), maxent.ROWS) - 1
    times = np.bincount(rows.ravel(), minlength=maxent.ROWS)
    assert {1, 2, 3, maxent.LAYERS, maxent.LAYERS + 1} <= set(times) and times.max() > 999 and (times > 0).sum() > maxent.BLOCK
    e, truth = rng.random((n, maxent.WIDTH)).astype(np.float32), rng.integers(0, maxent.WIDTH, n)
    total = e.sum(1)
    each = e.astype(np.float64) / total[:, None]
    each[np.arange(n), truth] -= 1
    grad = np.zeros_like(w)
    for k in range(3):
        np.add.at(grad, rows[:, k], each)
    m._learn(1, rows, e, total, truth)
    square = 1 + (grad ** 2).sum(1) / maxent.WIDTH
    assert np.allclose(m.w[1], w - maxent.RATE / np.sqrt(square)[:, None] * grad, atol=1e-4)
    assert np.allclose(m.square[1], square, rtol=1e-3) and (m.steps[1] == times).all()


@pytest.mark.parametrize("size", [1, 20, 31, 32, 33, 500, 3000])
def test_maxent_tree_against_brute_force(size):
    """Paths, probabilities and one gradient step, node by node and feature by feature."""
    rng = np.random.default_rng(size)
    h = np.unique(rng.integers(1, 1 << 62, size).astype(np.uint64))
    counts = np.sort(rng.zipf(1.4, len(h)).clip(1, 10 ** 6))[::-1]
    v = maxent.Vocabulary(h, counts, 11)
    masses = np.append(counts, 11) + 1.0
    assert (np.diff(v.length[np.lexsort((v.length, -masses))]) >= 0).all()  # frequent tokens lie higher
    for node in range(len(v.bias)):  # each node's outcomes start from the counts
        under = [masses[[i for i in range(len(masses)) for d in range(v.length[i])
                         if v.node[d, i] == node and v.branch[d, i] == j]].sum() for j in range(maxent.WIDTH)]
        with np.errstate(divide="ignore"):
            assert np.allclose(np.exp(v.bias[node]), np.array(under) / max(sum(under), 1), atol=1e-5)
        if node > 3:
            break
    m = maxent.Model(v, rng.normal(size=(2, maxent.ROWS, maxent.WIDTH)) * 0.5)
    w = m.w.astype(np.float64)
    every = np.append(h, np.uint64(5))[:40]
    before, skip = (rng.integers(1, 1 << 62, len(every)).astype(np.uint64) for _ in range(2))
    features = maxent.Model.rows(before, skip)
    grad, want = np.zeros_like(w), []
    for i, token in enumerate(every):
        leaf = int(np.flatnonzero(h == token)[0]) if token in h else len(h)
        log = 0.0
        for d in range(v.length[leaf]):
            node, t = int(v.node[d, leaf]), min(d, 1)
            at = [int((maxent.mix(f + np.uint64(node) * maxent.GOLD) if d else f) >> maxent.SHIFT) for f in features[i]]
            x = v.bias[node].astype(np.float64) + sum(w[t, a] for a in at)
            p = np.exp(x - x.max())
            p /= p.sum()
            log += np.log10(p[v.branch[d, leaf]])
            p[v.branch[d, leaf]] -= 1
            for a in at:
                grad[t, a] += p
        want.append(log)
    got, _ = m.log10(every, before, skip, learn=True)
    assert np.allclose(got, want, atol=1e-4)
    square = 1 + (grad ** 2).sum(2) / maxent.WIDTH
    assert np.allclose(m.w, w - maxent.RATE / np.sqrt(square)[:, :, None] * grad, atol=1e-4)


def test_maxent_vocabulary_grows_with_the_input():
    """A larger vocabulary scores held-out text better; its size follows the square root of the tokens."""
    rng = np.random.default_rng(4)
    nouns = [f"noun{i}" for i in range(3000)]

    def text():
        out = []
        for _ in range(60):
            k = int(min(rng.zipf(1.2), 3000)) - 1
            out += ["the", nouns[k], "is", nouns[(k * 7 + 1) % 3000]]
        return maxent.tokens(" ".join(out).encode())
    train, held = [text() for _ in range(400)], [text() for _ in range(40)]
    h, n = np.unique(np.concatenate(train), return_counts=True)
    scores = []
    for size in (30, 300, 2000):
        top = np.argsort(-n, kind="stable")[:size]
        m = maxent.Model(maxent.Vocabulary(h[top], n[top], int(n.sum() - n[top].sum())))
        for i in range(0, len(train), 20):
            m.log10(*maxent.contexts(train[i:i + 20]), learn=True)
        out, place = m.log10(*maxent.contexts(held))
        counts = dict(zip(h.tolist(), n.tolist()))
        rest, kinds = n.sum() - n[top].sum(), len(h) - len(top)
        seen = np.array([counts.get(x, 0) for x in np.concatenate(held).tolist()])
        scores.append((out + np.where(place < 0, np.log10((seen + 1) / (rest + kinds + 1)), 0)).mean())
    assert scores[0] < scores[1] < scores[2]


def test_maxent_packs_rare_tokens_in_small_rows():
    """Rows and batches of packed tokens stay small, and hold each (token, document) once, however many there are."""
    rng = np.random.default_rng(33)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 60000)).encode() for _ in range(10)] + [None, b"a A b"]
    ids, trains = [str(i) for i in range(len(texts))], [i % 3 > 0 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(trains), pa.array(texts, pa.binary())], names=["a", "b", "c"])
    some = maxent.tokens(b"a")
    out = list(maxent._scatter(some, 2)(iter([batch])))
    rows = [r for b in out for r in b.to_pylist()]
    assert max(b.nbytes for b in out) < 4 << 20 and max(len(r["body"]) for r in rows) < 1 << 19
    assert [r["bucket"] for r in rows].count(-1) == 1
    got = Counter()
    for r in rows:
        if r["bucket"] >= 0:
            key, h, owner, n, train = maxent.unpack(r["body"])
            assert (h >> np.uint64(63) == r["bucket"]).all()
            got.update(zip(key[owner].tolist(), h.tolist(), n.tolist(), train.tolist()))
    want = Counter()
    for i, train, text in zip(ids, trains, texts):
        h, n = np.unique(maxent.tokens(text), return_counts=True)
        rest = ~np.isin(h, some)
        key = maxent.row_key(i, text)
        want.update((key, x, k, train) for x, k in zip(h[rest].tolist(), n[rest].tolist()))
    assert got == want


def test_maxent_counts_a_large_bucket_in_little_memory():
    """Two buckets in one task, one of 2 million (token, document): sums as by brute force, and little beside the packed rows."""
    rng, rows, pairs = np.random.default_rng(34), [], []
    for bucket, bodies in ((0, 256), (1, 3)):
        for i in range(bodies):
            key = np.sort(rng.integers(0, 1 << 63, 50).astype(np.uint64)) + np.uint64(i)
            if i % 100 == 1:
                key = pairs[-1][1]  # documents that go on in another row
            h = maxent.mix(rng.integers(1, 600000, 8192).astype(np.uint64)) >> np.uint64(1) | np.uint64(bucket << 63)
            owner, n = np.sort(rng.integers(0, 50, 8192)).astype(np.uint32), rng.integers(2, 9, 8192).astype(np.uint32)
            rows.append((bucket, np.int64([50, 8192]).tobytes() + key.tobytes() + h.tobytes() + owner.tobytes() + n.tobytes()))
            pairs.append((bucket, key, h, owner, n))
    rows.insert(0, (-1, np.arange(3).tobytes()))
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[a:a + 16]], pa.int32()),
                                           pa.array([r[1] for r in rows[a:a + 16]], pa.binary())], names=["b", "y"])
               for a in range(0, len(rows), 16)]
    tracemalloc.start()
    out = [r for b in maxent._tally(3)(iter(batches)) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 * 8192 * 256
    assert [r["tokens"] for r in out if r["place"] is not None] == [0, 1, 2]
    totals = [(r["tokens"], r["kinds"]) for r in out if r["kinds"] is not None]
    sums = {}
    for r in out:
        if r["part"] is not None:
            key, logs, known = np.frombuffer(r["body"], np.uint64).reshape(3, -1)
            assert ((key >> np.uint64(32)) * np.uint64(3) >> np.uint64(32) == r["part"]).all()
            for k, x, c in zip(key.tolist(), logs.view(np.float64).tolist(), known.tolist()):
                sums[k] = (sums.get(k, (0, 0))[0] + x, sums.get(k, (0, 0))[1] + c)
    want, want_totals = {}, []
    for bucket in (0, 1):
        key, h, n = (np.concatenate(x) for x in zip(*((k[o], h, n) for b, k, h, o, n in pairs if b == bucket)))
        _, token = np.unique(h, return_inverse=True)
        c = np.bincount(token, (n >> 1) * (n & 1))
        want_totals.append((int(c.sum()), int((c > 0).sum())))
        docs, at = np.unique(key, return_inverse=True)
        logs, known = np.bincount(at, (n >> 1) * np.log10(c[token] + 1)), np.bincount(at, (n >> 1) * (c[token] > 0))
        for k, x, m in zip(docs.tolist(), logs.tolist(), known.tolist()):
            want[k] = (want.get(k, (0, 0))[0] + x, want.get(k, (0, 0))[1] + m)
    assert totals == want_totals and sums.keys() == want.keys()
    assert all(abs(sums[k][0] - want[k][0]) < 1e-6 and sums[k][1] == want[k][1] for k in want)


def test_maxent_hands_packed_rows_over_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    with maxent._small_batches(spark):
        got = [r.n for r in spark.range(0, 160, 1, 1).selectExpr("repeat('x', 100000) as x").mapInArrow(sizes, "n long").collect()]
    assert sum(got) >= 16_000_000 and max(got) < 2 * maxent.BATCH_BYTES
    assert spark.conf.get(key, None) == before


def test_maxent_edges(spark, empty):
    assert maxent.score_texts(empty).collect() == []
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = maxent.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
