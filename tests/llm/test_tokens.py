"""Token counts, tokenizer alignment and the filter audit against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metricfold.llm import alignment, potential, queries, transducer

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = ["", " ", "a", "  lead and  double   spaces ", "\n\ttabs\r\nlines\n", "<s>special</s> <|endoftext|> strings",
         "a▁b", "naïve Ångström ｆｕｌｌ 梦想 😀\U0001F469‍\U0001F680", "zero\x00byte​joiner",
         "I'll we've 'tis ''quoted''", "x" * 3000, "ab" * 2500 + " " + "語" * 500, "1234567890 " * 300,
         " " * 1000 + "end", "word " * 4200, "﻿bom"]


@pytest.fixture(scope="module")
def machine():
    with open(MODEL, "rb") as f:
        return transducer.Transducer(transducer.vocabulary(f.read()))


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def random_texts(pieces, n, seed):
    rng = random.Random(seed)
    words = [pieces.id_to_piece(rng.randrange(259, 32000)).replace("▁", " ") for _ in range(400)]
    pools = [words, list("abceilnorst  \n.,'"), list("aen "), list("é梦😀\x00\t ▁01ß"), [" ", "  ", "the", "'s", "-"]]
    return ["".join(rng.choices(rng.choice(pools), k=rng.randint(0, 30))) for _ in range(n)]


# --- Transducer ----------------------------------------------------------------

def test_transducer_equals_library(machine, pieces):
    for t in TEXTS + random_texts(pieces, 4000, 3):
        assert machine.count(t) == len(pieces.encode(t)), repr(t)


def test_chunk_maps_compose_in_any_tree(machine, pieces):
    rng = random.Random(11)
    for t in TEXTS + random_texts(pieces, 600, 4):
        size = rng.randint(1, 40)
        maps = [machine.chunk_map(p, i == 0) for i, p in enumerate(transducer._cut(t, size))]
        while len(maps) > 1:
            i = rng.randrange(len(maps) - 1)
            maps[i:i + 2] = [machine.compose(maps[i], maps[i + 1])]
        assert (maps[0][2] if maps else 0) == len(pieces.encode(t)), repr(t)


def test_tables_stay_bounded(pieces, monkeypatch):
    monkeypatch.setattr(transducer, "TRANSITIONS", 50)
    monkeypatch.setattr(transducer, "WORDS", 5)
    with open(MODEL, "rb") as f:
        small = transducer.Transducer(transducer.vocabulary(f.read()))
    for t in TEXTS + random_texts(pieces, 300, 5):
        assert small.count(t) == len(pieces.encode(t))
        assert len(small.steps) <= 50 and len(small.words) <= 5 and len(small.fits) <= 50


def test_other_vocabularies_are_refused(tmp_path):
    bad = tmp_path / "not.model"
    bad.write_bytes(b"no model")
    with pytest.raises(Exception):
        transducer.vocabulary(bad.read_bytes())


def test_count_tokens_rows(spark, pieces):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate([*TEXTS, *TEXTS[5:9], None, "tail " * 3000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = transducer.count_tokens(docs, MODEL, chunk=100, fan=3)
    want = Counter((i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 4096)
                   for i, t, _ in rows)
    assert Counter(map(tuple, got.collect())) == want
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert transducer.count_tokens(docs.limit(0), MODEL).count() == 0
    named = transducer.count_tokens(docs.selectExpr("cast(doc_id AS string) AS name", "text AS body"), MODEL, "name", "body")
    assert named.count() == len(rows) and named.schema["name"].dataType.simpleString() == "string"


def test_op11_query(spark, pieces):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op11_transducer(spark, SF).collect()
    assert sorted(tuple(r) for r in got) == sorted(
        (i, len(t.encode()), n, n > 4096) for i, t in docs.items() for n in [len(pieces.encode(t))])


# --- Alignment -----------------------------------------------------------------

def brute_alignment(texts):
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(x): x for x in keep}
    chars.update({chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in keep)})
    docs, held = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        ia = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ib = b.encode(t) if t else []
        ba = [bytes(chars[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
              for i in ib]
        if not t or b"".join(ba) != raw or b"".join(bb) != raw:
            docs.append(([], [], [], []))
            continue
        spans = [list(zip(itertools.accumulate(map(len, x), initial=0), itertools.accumulate(map(len, x)))) for x in (ba, bb)]
        links, j0 = [], 0
        for x, (s, e) in zip(ia, spans[0]):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(ib) and spans[1][j][0] < e:
                links.append((x, ib[j]))
                j += 1
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups = ["|".join(",".join(str(x) for x, (s, e) in zip(ids, sp) if lo <= s and e <= hi)
                           for ids, sp in zip((ia, ib), spans)) for lo, hi in zip([0, *both], both)] if len(raw) < 2000 else None
        docs.append((ia, ib, links, groups or both))
        held.update(set(links))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    return [(len(ia), len(ib), len(g), len(k), sum(held[p] == top[p[0]] for p in k), sum(held[p] for p in k),
             "" if not ia else hashlib.sha256(";".join(g).encode()).hexdigest() if isinstance(g[0], str) else None)
            for ia, ib, k, g in docs]


def as_rows(df):
    return df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_brute_force(spark, pieces):
    texts = [*TEXTS, None, *TEXTS[7:10], *random_texts(pieces, 150, 9), "one two three. Four five", "a b▁c d"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id here", "y"), (0, "again", "z")]
    want = [(i, *w) for (i, _, _), w in zip(rows, brute_alignment([t for _, t, _ in rows]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string").repartition(3)
    for options in ({}, {"block_docs": 7}, {"block_chars": 100}):
        got = sorted(map(tuple, as_rows(alignment.align(docs, BYTES, MODEL, **options)).collect()), key=str)
        assert len(got) == len(want)
        for g, w in zip(got, sorted(want, key=str)):
            assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])
    assert alignment.align(docs.limit(0), BYTES, MODEL).count() == 0


def test_alignment_long_text_and_small_tables(spark, monkeypatch):
    """A text of many pieces, taken slice by slice, with the table emptied in between."""
    rng = random.Random(2)
    text = " ".join("".join(rng.choices("abcdehlnorst", k=rng.randint(2, 6))) for _ in range(1500))
    want = brute_alignment([text, "short one", text[:1900]])
    two = alignment.Pair(open(BYTES, encoding="utf-8").read(), open(MODEL, "rb").read())
    monkeypatch.setattr(alignment, "SLICE", 100)
    monkeypatch.setattr(alignment, "WORDS", 150)
    block = alignment.Block()
    alignment._encode([1, 2, 3], [text, "short one", text[:1900]], two, block)
    block.fold()
    assert [r[1:4] for r in block.rows] == [w[:3] for w in want]
    assert [r[4] for r in block.rows][1:] == [w[6] for w in want][1:]
    assert block.counts.sum() == sum(w[3] for w in want)


def test_planes_round_trip():
    import numpy as np
    rng = np.random.default_rng(1)
    for docs in (1, 40, 5000):
        keys = np.unique(rng.integers(0, 60 * docs, 4 * docs))
        pair, place = keys // docs, keys % docs
        p, q = alignment.unpack(alignment.pack(pair, place, 61, docs))
        assert sorted(zip(p.tolist(), q.tolist())) == sorted(zip(pair.tolist(), place.tolist()))


def test_op13_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(i, *w) for (i, _), w in zip(docs, brute_alignment([t for _, t in docs]))]
    got = sorted(map(tuple, as_rows(queries.op13_alignment(spark, SF)).collect()))
    for g, w in zip(got, sorted(want)):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])
    assert len(got) == len(want)


# --- Filter audit --------------------------------------------------------------

def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    fails = []
    for i, t, part in docs:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\v\f\r " else c for c in t).split(" ") if w]
        f = {x for x, hit in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and i > first[t])) if hit}
        fails.append((part or "", f, i in good, i in toxic))
    out = []
    for part in {p for p, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        rows, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order):
                before = set(order[:step])
                gone = [bool(x[1] & before) for x in mine]
                hit = [f in x[1] for x in mine]
                removed = [h and not g for h, g in zip(hit, gone)]
                shapley[f] += sum(removed)
                rows.append((f, "".join(order), step + 1, sum(not h and not g for h, g in zip(hit, gone)), sum(removed),
                             sum(h and g for h, g in zip(hit, gone)), sum(x[1] == {f} for x in mine),
                             sum(r and x[2] for r, x in zip(removed, mine)), sum(r and x[3] for r, x in zip(removed, mine))))
        out += [(part, *r[1:], shapley[r[0]]) for r in rows]
    return sorted(out)


def test_audit_brute_force(spark):
    rng = random.Random(8)
    pool = [None, "", " ", "word " * 60, "A B C", "50% off", " ".join(f"w{i}" for i in range(70)),
            " ".join(f"w{i}" for i in range(70)) + " #tag", "LOUD " * 55, "é " * 49, "x\x0by\x0cz"]
    docs = [(rng.choice([None, *range(40)]), rng.choice(pool), rng.choice(["a", "b", "", None])) for _ in range(400)]
    labels = [(rng.choice([None, *range(45)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)]
    d = spark.createDataFrame([(*x, 1, "m") for x in docs], "doc_id long, text string, source string, n int, mask string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = potential.audit(d, lab)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)
    assert potential.audit(d.limit(0), lab).count() == 0
    assert potential.audit(d, lab.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
    as_text = potential.audit(d.withColumn("doc_id", F.format_string("%03d", "doc_id")), lab.withColumn(
        "doc_id", F.format_string("%03d", "doc_id")))
    assert as_text.count() == got.count()


def test_potential_is_the_mean_over_orders(spark):
    """Recursion over coalitions against the marginals of all orders, on any game."""
    rng = random.Random(4)
    game = [0, *(rng.randint(0, 10 ** 12) for _ in range(31))]
    p = spark.createDataFrame([(game,)], "v array<long>").select(potential.potentials(F.col("v"))).first()[0]
    for f in range(5):
        total = 0
        for order in itertools.permutations(range(5)):
            before = sum(1 << x for x in order[:order.index(f)])
            total += game[before | 1 << f] - game[before]
        assert p[31] - p[31 ^ 1 << f] == total
