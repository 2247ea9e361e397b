"""Embedding, WARC, URL and pipeline operators against brute force."""

import base64
import hashlib
import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricfold.llm import hnsw, urlrank, warc
from metricfold.llm.common import Scratch, components

SF = "/root/testdata/sf0.001"


# --- Components ---------------------------------------------------------------

def test_components_shapes(spark):
    n = 300
    edges = [(i, i + 1) for i in range(0, n)] + [(1000, 1000 + i) for i in range(1, 200)] \
        + [(5000, 4000), (4000, 4500), (7, 7)] + [(2000 + i, 2000 + (i * 7) % 50) for i in range(50)]
    got = {r.node: r.component for r in components(
        Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


# --- HNSW ---------------------------------------------------------------------

def brute_links(rows):
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, root = {i: set() for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, v) in enumerate(ok):
        for j, w in ok[:a]:
            if i != j and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= 0.95:
                links[i].add(j)
                links[j].add(i)
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(links[i]), find(i)) for i, _ in rows if i is not None}


def test_hnsw_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 16))
    rows = []
    for i in range(900):
        v = base[i % 400] if i < 700 else base[3]
        rows.append((i, (v + rng.normal(size=16) * (0.02 if i >= 700 else rng.choice([0, 0.1, 0.3]))).tolist()))
    rows += [(901, None), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None] + [0.0] * 14),
             (905, []), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [1e300] * 16), (909, [1e-300] * 16)]
    want = brute_links([r for r in rows if r[0] < 908])
    want[908] = want[909] = (1, 908)
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("size", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(d).collect()}
    right = sum(got[i][0] for i in got)
    assert right <= sum(w[0] for w in want.values()) and right >= 0.99 * sum(w[0] for w in want.values())
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    for i in range(901, 908):
        assert got[i] == want[i]


def test_hnsw_crowds_write_rows_in_proportion(spark, monkeypatch):
    """Near-equal vectors: all are linked, with rows linear in their number; files are opened once a task."""
    written = {}

    class Counting(Scratch):
        def table(self, df, name):
            out = super().table(df, name)
            written[name] = out.count()
            return out
    monkeypatch.setattr(hnsw, "Scratch", Counting)
    rng = np.random.default_rng(9)
    rows = {}
    for n in (300, 900, 2700):
        base = rng.normal(size=8)
        data = [(i, (base + rng.normal(size=8) * 1e-3).tolist()) for i in range(n)] + [(n, (-base).tolist())]
        got = hnsw.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>"), crowd=16).collect()
        assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, n - 1, 0) for i in range(n)} | {(n, 0, n)}
        rows[n] = written["found"]
    assert rows[900] <= 3.2 * rows[300] and rows[2700] <= 3.2 * rows[900] and rows[2700] < 2700 * 8 * 3


def test_hnsw_crowds_and_pairs_agree(spark):
    """What a crowd's queries count equals what pairs give, whatever the bound between the two."""
    rng = np.random.default_rng(10)
    base = rng.normal(size=(30, 8))
    data = [(i, (base[i % 7 if i % 3 else i % 30] + rng.normal(size=8) * 0.05).tolist()) for i in range(600)]
    data += [(1000 + i, data[i][1]) for i in range(0, 60, 2)]
    d = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = brute_links(data)
    for crowd in (0, 3, 10 ** 9):
        got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(d, crowd=crowd).collect()}
        assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_hnsw_recall_on_table(spark):
    d = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in d.collect()]
    want = brute_links(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(d).collect()}
    assert got == want


def test_hnsw_edges(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw.near_duplicates(none).collect() == []
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (3, [1.0, 0.0])]
    got = hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {(r.vec_id, r.component_id, r.kept) for r in got} == \
        {(None, None, True), (1, 1, True), (2, 1, False), (3, 1, False)}


# --- WARC ---------------------------------------------------------------------

def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [(i, f"http://h{i % 3}.net/{i}", f"<p>é{i % 7}</p>" + "x\r\n\r\n" * (i % 5) * 50) for i in range(40)] + [
    (50, None, None), (51, "http://a b\r\nX: y/", ""), (52, "u", "z" * 300_000), (None, "n", "<p>é1</p>"),
    (3, "http://again", f"<p>é3</p>" + "x\r\n\r\n" * 150), (10 ** 15, "far", "<p>far</p>"), (-5, "low", "<p>é2</p>")]


def test_warc_round_trip(spark, scratch):
    d = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")
    root = "file:" + scratch + "/warc"
    manifest = warc.write_archive(d.repartition(4), root, shard_bytes=4000, roll_bytes=600).collect()
    got = warc.read_archive(spark, root, payloads=True).collect()
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            p = (html or "").encode()
            first[p] = min(first.get(p, i), i)
    want = []
    for i, _, html in PAGES:
        p = (html or "").encode()
        other = first.get(p) if i is not None and first.get(p) != i else None
        want.append((i, len(p), sha(p), "response" if other is None else "revisit", other))
    assert sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got))) \
        == sorted(map(repr, want))
    bodies = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    for i, _, html in PAGES:
        if i in bodies:
            assert bodies[i] == (html or "").encode()
    assert sum(m.records for m in manifest) == len(PAGES) and len(manifest) > 3
    order = [r.page_id for r in sorted(got, key=lambda r: r.file)]
    assert len({r.file for r in got}) == len(manifest) and len(order) == len(PAGES)
    again = "file:" + scratch + "/again"
    second = warc.write_archive(d.repartition(7), again, shard_bytes=4000, roll_bytes=600).collect()
    assert {(m.name, m.sha256) for m in second} == {(m.name, m.sha256) for m in manifest}


def test_warc_small_payloads_stay_whole(spark, scratch):
    d = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")],
                              "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(d, scratch + "/w", min_bytes=4).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    assert warc.round_trip(d.limit(0), scratch + "/none").collect() == []


# --- URLs ---------------------------------------------------------------------

def test_url_rules_and_parts(spark):
    rows = [(1, "http://A.Example.NET/en/x?q#f"), (2, "https://a.net?x"), (3, "https://a.net/x"), (4, None), (5, "a/b"),
            (6, "x://example.com/de/"), (7, "x://example.com/fr/de/"), (8, "x://www.org/fr/a"), (9, "x://org.fr/fr/"),
            (10, "x://h://i/j"), (11, "://#"), (12, "http://notexample.com/de/"), (3, "https://a.net/x")]
    d = spark.createDataFrame([(*r, None, "z") for r in rows], "page_id long, url string, html string, rule string")
    got = [tuple(r)[:4] for r in urlrank.verdicts(d).collect()]
    want = [(1, "a.example.net", "/en/x", "example.net/en/"), (2, "a.net", "", None), (3, "a.net", "/x", "net/"),
            (4, "", "", None), (5, "", "", None), (6, "example.com", "/de/", "example.com/de/"),
            (7, "example.com", "/fr/de/", None), (8, "www.org", "/fr/a", "org/fr/"), (9, "org.fr", "/fr/", None),
            (10, "h:", "//i/j", None), (11, "", "", None), (12, "notexample.com", "/de/", None), (3, "a.net", "/x", "net/")]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert urlrank.verdicts(d.limit(0)).collect() == []


def test_url_propagation(spark):
    """Hosts that link to blocked ones are blocked, those that trusted ones link to are allowed."""
    rows = [(1, "http://good.org/fr/a", '<a href="http://friend.io/x">'), (2, "http://bad.net/", None),
            (3, "http://spam.io/", "<a class=x HREF='//bad.net/y'><a href=/local>"), (4, "http://friend.io/", "<a href=\"z\">"),
            (5, "http://alone.io/", ""), (6, "http://sub.spam.io/a", "")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urlrank.judge(d).collect()}
    assert {i: r.verdict for i, r in got.items()} == \
        {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block"}
    # Brute-force propagation.
    import collections
    edges = collections.Counter({("good.org", "friend.io"): 1.0, ("spam.io", "bad.net"): 1.0,
                                 ("sub.spam.io", "spam.io"): 1.0, ("spam.io", "sub.spam.io"): 1.0})
    for name, seed, flow in (("trust", "good.org", edges), ("distrust", "bad.net", {(b, a): w for (a, b), w in edges.items()})):
        out = collections.Counter()
        for (a, _), w in flow.items():
            out[a] += w
        rank = {seed: 1.0}
        for _ in range(300):
            new = collections.Counter({seed: 1 - urlrank.DAMPING})
            for (a, b), w in flow.items():
                new[b] += urlrank.DAMPING * w / out[a] * rank.get(a, 0)
            rank = new
        for r in got.values():
            assert abs(getattr(r, name) - rank.get(r.host, 0.0)) <= urlrank.TOLERANCE


def test_url_propagation_reaches_the_end_of_a_chain(spark):
    """Fourteen hosts, each linking to the next, the last to a blocked one."""
    rows = [(i, f"http://h{i}.io/", f'<a href="http://h{i + 1}.io/">' if i < 14 else '<a href="http://bad.net/">')
            for i in range(1, 15)] + [(99, "http://apart.io/", None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlrank.verdicts(d).collect()}
    assert got.pop(99) == "allow" and set(got.values()) == {"block"} and len(got) == 14


def test_url_sql_on_absolute_links(spark):
    """The SQL's link-target seeds and rounds, on a random web with absolute links."""
    import random

    import duckdb
    rng = random.Random(12)
    hosts = [f"{a}{b}" for a in ("", "www.", "m.") for b in ("a.io", "b.org", "c.net", "example.net", "example.com", "d.de", "e.co.uk")]
    paths = ["", "/", "/en/x", "/de/y", "/fr/z?q", "/a#f"]
    link = lambda: f'<a href={rng.choice(["", chr(34)])}{rng.choice(["http:", "https:", ""])}//{rng.choice(hosts)}{rng.choice(paths)}>'
    rows = [(i, None if i % 31 == 0 else f"http://{rng.choice(hosts)}{rng.choice(paths)}",
             None if i % 17 == 0 else " ".join([link() for _ in range(rng.randint(0, 3))] + ['<a href="/own">'])) for i in range(150)]
    got = sorted(map(repr, map(tuple, urlrank.verdicts(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect())))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    rel = con.sql(urlrank.verdicts_sql())
    order = [rel.columns.index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in rel.fetchall())
    assert len({r.split(",")[-1] for r in got}) == 2


def test_url_seeds_from_link_targets(spark):
    """A blocked or allowed url that is only linked to is a seed too."""
    rows = [(1, "http://spam.io/", '<a href="http://X.net/y?q"> <a href=//x.net/y#z>'), (2, "http://alone.io/", '<a href="/a">'),
            (3, "http://mixed.io/", '<a href="https://sub.org/fr/b"><a href="/">'),
            (4, "http://good.io/", '<a href="//x.net"> <a href="//example.com/fr/">')]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urlrank.judge(d).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert got[1].distrust > 0 and got[1].rule is None and got[2].distrust == 0
    seeds = urlrank.target_seeds(spark.createDataFrame(
        [("spam.io", "/", None, rows[0][2]), ("mixed.io", "/", None, rows[2][2]), ("x.net", "/y", "block", None)],
        "host string, path string, ruled string, html string")).collect()
    assert [tuple(r) for r in seeds] == [("sub.org", "allow")]


# --- Native operators run no Python -------------------------------------------

@pytest.mark.parametrize("name", ["op3_lines", "op10_urlrank"])
def test_native_plans(spark, name):
    from metricfold.llm import queries
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# --- Pipeline -----------------------------------------------------------------

def test_pipeline_stages(spark):
    """Each stage's decision equals the brute-force one on what it is given."""
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline as cp
    from tests.llm.test_text import brute_components, brute_contamination, brute_lines, brute_mix, words_ws
    d = spark.read.parquet(f"{SF}/documents.parquet")
    columns = d.columns
    stage = dict(cp.STAGES)
    scratch = Scratch(spark, "t")
    one = scratch.table(stage["language_id"](spark, d, SF), "one")
    assert one.columns == columns
    before, after = d.count(), one.count()
    letters = d.where(F.col("text").rlike(r"\p{L}")).count()
    assert after >= 0.98 * letters and after <= before
    two = scratch.table(stage["line_dedup"](spark, one, SF), "two")
    rows = [tuple(r) for r in one.collect()]
    gone = brute_lines([(r[0], r[1]) for r in rows])
    drop = {}
    for g in gone:
        drop.setdefault(g[0], set()).add(g[1])
    want = {}
    for r in rows:
        text = r[1] if r[1] is None or r[0] not in drop else \
            "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in drop[r[0]])
        if r[0] not in drop or words_ws(text):
            want[r[0]] = text
    got = {r.doc_id: r for r in two.collect()}
    assert {i: r.text for i, r in got.items()} == want and two.columns == columns
    assert all(r.n_chars == len(r.text) for r in got.values() if r.text is not None)
    three = scratch.table(stage["near_dedup"](spark, two, SF), "three")
    sets = {}
    for i, text in want.items():
        w = words_ws(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = brute_components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b))
    assert {r.doc_id for r in three.collect()} == {i for i, c in comp.items() if i == c}
    four = scratch.table(stage["decontaminate"](spark, three, SF), "four")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {r.doc_id for r in three.collect() if not brute_contamination(r.text, items)[-1]}
    assert {r.doc_id for r in four.collect()} == kept and four.columns == columns
    five = {r.doc_id: r for r in stage["mix"](spark, four, SF).collect()}
    sizes, total, target = brute_mix([(r.doc_id, r.text, r.lang, r.source) for r in four.collect()])
    assert {i: (r.source, r.size) for i, r in five.items()} == {i: (s, z) for i, s, z in sizes}
    assert all(abs(r.target - target[r.source]) < 1e-6 and r.taken <= 2 * r.size for r in five.values())
    run = {tuple(r) for r in cp.run(spark, SF).collect()}
    assert run == {tuple(r) for r in five.values()}


def test_pipeline_nulls_and_empty(spark):
    import corpus_pipeline as cp
    schema = "doc_id long, text string, lang string, source string, n_chars int, _gone string, spans string, x string"
    rows = [(1, "the the words here are some words", "en", "a", 3, "g", "s", "x"), (2, None, None, None, None, None, None, None),
            (3, "", "en", "a", 0, None, None, None), (None, "der die das und noch mehr worte", "de", None, 1, None, None, None),
            (1, "the the words here are some words", "en", "a", 3, "g", "s", "x"), (4, "w " * 30000, "en", "a", 1, None, None, None)]
    for given in (rows, []):
        d = spark.createDataFrame(given, schema)
        for name, f in cp.STAGES:
            out = f(spark, d, SF)
            out.collect()
            if name != "mix":
                assert out.columns == d.columns
