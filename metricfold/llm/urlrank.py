"""URL filters: rules first, then link-graph propagation over hosts. DataFrame
and SQL functions only.

Hosts are nodes. A page's links to other hosts are edges, weighted by the
pages that hold them; a host and its parent domain (of two labels or more) are
joined both ways, so that the graph also spans sites whose links are all
relative. Trust starts at the hosts of urls that a rule allows, and follows
the edges (personalised PageRank, DAMPING); distrust starts at
the hosts of urls that a rule blocks, and follows the edges backwards, from a
blocked host to those that link to it. These urls are the pages' own and those
that pages link to on other hosts and that are no page themselves. Both start
with mass 1 in proportion to pages and such urls; mass that reaches a host
without edges ends there. Rounds go on until the mass still on its way is at
most TOLERANCE, so that no score misses more than that (20 rounds, or fewer where
mass ends early). A host whose distrust exceeds THRESHOLD times its trust, by
more than one part in a million, is blocked; any other is allowed.

Edges, seeds and rank sums are partial aggregates, so a host with a third of
all pages is reduced before the shuffle. Every round is a table in the shared
folder. Verdicts are joined to the pages by host, from a table, so that the
join of a hot host can be split.

Defined results: a url that is null or has no '://' has an empty host and path,
no rule, and is allowed; null html has no links; repeated rows are judged one
by one; the null page_id is an id like others. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

# Fixed values of the contract: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DAMPING = 0.5  # a link carries half of a host's trust or distrust on
TOLERANCE = 1e-6
TOGETHER = 2  # rounds between two looks at the mass left
THRESHOLD = 1.0
MARGIN = 1 + 1e-6  # sums of equal scores may differ in their last digits
LINK = r"""(?i)\shref\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
TARGET = r"""(?i)\shref\s*=\s*["']?(?:https?:)?(//[^/?#"'\s>]+[^?#"'\s>]*)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url):
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url):
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_columns(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, or nulls."""
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        rule = F.when(fits(h, p), h + p) if rule is None else rule.when(fits(h, p), h + p)
        verdict = F.when(fits(h, p), v) if verdict is None else verdict.when(fits(h, p), v)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """src, dst, weight of links between different hosts; pages has host."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1)),
        lambda x: F.translate(x, UPPER, LOWER)))).alias("dst")) \
        .where("src <> '' and dst <> '' and src <> dst") \
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    return links


def target_seeds(judged: DataFrame, rules=RULES, html_col: str = "html") -> DataFrame:
    """host, ruled of every url that a rule fits, that a page of another host
    links to, and that is no page; judged has host, path and ruled."""
    urls = judged.select(F.col("host").alias("src"), F.explode(F.array_distinct(
        F.regexp_extract_all(F.col(html_col), F.lit(TARGET), F.lit(1)))).alias("url")) \
        .select("src", F.concat(F.lit("x:"), "url").alias("url")) \
        .select("src", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    urls = urls.withColumn("ruled", rule_columns(F.col("host"), F.col("path"), rules)[1]) \
        .where("ruled is not null and src <> '' and src <> host").select("host", "path", "ruled").distinct()
    pages = judged.where("ruled is not null").select("host", "path").distinct()
    return urls.join(pages, ["host", "path"], "left_anti").select("host", "ruled")


def parent_edges(hosts: DataFrame) -> DataFrame:
    """Both ways between each host and its parent domains of two labels or more."""
    labels = F.split("host", r"\.")
    chain = hosts.where("host <> ''").select(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")).alias("names"))
    up = chain.select(F.explode(F.arrays_zip(
        F.slice("names", 1, F.greatest(F.size("names") - 1, F.lit(0))).alias("a"),
        F.slice("names", 2, F.size("names")).alias("b"))).alias("e")) \
        .select(F.col("e.a").alias("src"), F.col("e.b").alias("dst")).distinct()
    return up.unionAll(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) \
        .withColumn("weight", F.lit(1.0))


def propagate(scratch: Scratch, edges: DataFrame, seeds: DataFrame, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """kind, host, score. seeds has kind, host, mass; kind 'trust' moves from
    src to dst, kind 'distrust' from dst to src. A score is the sum over all
    rounds of the mass that stops at the host; rows carry that sum and the mass
    that arrived last. The driver sees one sum every TOGETHER rounds."""
    flow = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "weight") \
        .unionAll(edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "weight"))
    out = flow.groupBy("kind", "a").agg(F.sum("weight").alias("all"))
    flow = scratch.table(flow.join(out, ["kind", "a"])
                         .select("kind", "a", "b", (F.col("weight") / F.col("all")).alias("part")), "flow")
    rank = scratch.table(seeds.select("kind", "host", F.col("mass").alias("moving"),
                                      ((1 - damping) * F.col("mass")).alias("score")), "rank")
    while (rank.groupBy("kind").agg(F.sum("moving").alias("m")).agg(F.max("m")).first()[0] or 0.0) > tolerance:
        new = rank
        for _ in range(TOGETHER):
            sent = new.where("moving > 0").select("kind", F.col("host").alias("a"), "moving")
            moved = flow.join(sent, ["kind", "a"]) \
                .select("kind", F.col("b").alias("host"), (damping * F.col("part") * F.col("moving")).alias("moving"),
                        F.lit(0.0).alias("score"))
            new = moved.unionAll(new.select("kind", "host", F.lit(0.0), "score")) \
                .groupBy("kind", "host").agg(F.sum("moving").alias("moving"), F.sum("score").alias("score")) \
                .withColumn("score", F.col("score") + (1 - damping) * F.col("moving"))
        new = scratch.table(new, "rank")
        scratch.drop(rank)
        rank = new
    return rank.select("kind", "host", "score")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    spark = prepare(pages.sparkSession)
    scratch = Scratch(spark, "urls")
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                         F.col(html_col).alias("html"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    judged = named.withColumn("rule", rule).withColumn("ruled", verdict)
    marks = judged.select("host", "ruled", F.lit(True).alias("page")) \
        .unionAll(target_seeds(judged, rules).withColumn("page", F.lit(False)))
    counts = marks.groupBy("host").agg(F.max("page").alias("page"),
                                       F.expr("count_if(ruled = 'allow')").cast("double").alias("trust"),
                                       F.expr("count_if(ruled = 'block')").cast("double").alias("distrust"))
    counts = scratch.table(counts.where("host <> ''"), "hosts")
    sums = counts.agg(F.sum("trust"), F.sum("distrust")).first()
    seeds = counts.select(F.lit("trust").alias("kind"), "host", (F.col("trust") / float(sums[0] or 1)).alias("mass")) \
        .unionAll(counts.select(F.lit("distrust"), "host", F.col("distrust") / float(sums[1] or 1))) \
        .where("mass > 0")
    edges = scratch.table(
        host_edges(named).unionAll(parent_edges(counts.where("page").select("host")))
        .groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "edges")
    rank = propagate(scratch, edges, seeds)
    scores = rank.groupBy("host").agg(F.sum(F.expr("if(kind = 'trust', score, 0.0D)")).alias("trust"),
                                      F.sum(F.expr("if(kind = 'distrust', score, 0.0D)")).alias("distrust"))
    scores = scratch.table(scores.withColumnRenamed("host", "_host"), "scores")
    bad = F.coalesce(F.col("distrust"), F.lit(0.0)) > threshold * MARGIN * F.coalesce(F.col("trust"), F.lit(0.0))
    return judged.select("page_id", "host", "path", "rule", "ruled") \
        .join(scores, F.col("host") == F.col("_host"), "left") \
        .select("page_id", "host", "path", "rule",
                F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def verdicts(pages: DataFrame, **options) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    return judge(pages, **options).drop("trust", "distrust")


def verdicts_sql(rounds: int = 40) -> str:
    """The same in DuckDB SQL: the rounds are a recursive query, as many as
    leave less than a tenth of the tolerance on its way."""
    order = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))" for h, p, _ in order]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (h, p, _) in zip(fits, order))
    ruled = " ".join(f"WHEN {f} THEN '{v}'" for f, (_, _, v) in zip(fits, order))
    host = "translate(coalesce(regexp_extract({0}, '://([^/?#]*)', 1), ''), '" + f"{UPPER}', '{LOWER}')"
    path = "coalesce(regexp_extract({0}, '://[^/?#]*([^?#]*)', 1), '')"
    return rf"""
WITH RECURSIVE
u AS (SELECT page_id, html, {host.format("url")} AS host, {path.format("url")} AS path FROM pages),
j AS (SELECT page_id, html, host, path, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM u),
v AS (SELECT DISTINCT src, {host.format("url")} AS host, {path.format("url")} AS path FROM (
        SELECT host AS src, 'x:' || unnest(regexp_extract_all(html,
          '\shref\s*=\s*["'']?(?:https?:)?(//[^/?#"''\s>]+[^?#"''\s>]*)', 1, 'i')) AS url FROM u) y),
x AS (SELECT DISTINCT host, path, CASE {ruled} END AS ruled FROM v WHERE src <> '' AND src <> host),
m AS (SELECT host, ruled FROM j UNION ALL
      SELECT host, ruled FROM x WHERE ruled IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM j WHERE j.ruled IS NOT NULL AND j.host = x.host AND j.path = x.path)),
n AS (SELECT host, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad
      FROM m WHERE host <> '' GROUP BY host),
s AS (SELECT 'trust' AS kind, host, good / CAST((SELECT sum(good) FROM n) AS DOUBLE) AS mass FROM n WHERE good > 0
      UNION ALL SELECT 'distrust', host, bad / CAST((SELECT sum(bad) FROM n) AS DOUBLE) FROM n WHERE bad > 0),
k AS (SELECT DISTINCT page_id, host AS src, translate(unnest(regexp_extract_all(html,
      '\shref\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1, 'i')), '{UPPER}', '{LOWER}') AS dst FROM u),
c AS (SELECT DISTINCT host, string_split(host, '.') AS p FROM u WHERE host <> ''),
d AS (SELECT DISTINCT array_to_string(p[i:], '.') AS src, array_to_string(p[i + 1:], '.') AS dst
      FROM c, unnest(generate_series(1, len(p) - 2)) AS t(i)),
e AS (SELECT src, dst, sum(w) AS w FROM (
        SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM k WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
        UNION ALL SELECT src, dst, 1.0 FROM d UNION ALL SELECT dst, src, 1.0 FROM d) GROUP BY src, dst),
g AS (SELECT kind, a, b, w / sum(w) OVER (PARTITION BY kind, a) AS part FROM (
        SELECT 'trust' AS kind, src AS a, dst AS b, w FROM e UNION ALL SELECT 'distrust', dst, src, w FROM e)),
r AS (SELECT kind, host, mass AS moving, 0 AS round FROM s UNION ALL
      SELECT r.kind, g.b, sum({DAMPING} * g.part * r.moving), max(r.round) + 1
      FROM r JOIN g ON g.kind = r.kind AND g.a = r.host WHERE r.round < {rounds} GROUP BY r.kind, g.b),
f AS (SELECT kind, host, (1 - {DAMPING}) * sum(moving) AS score FROM r GROUP BY kind, host)
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN coalesce(b.score, 0) > {THRESHOLD * MARGIN!r} * coalesce(a.score, 0)
       THEN 'block' ELSE 'allow' END) AS verdict
FROM j LEFT JOIN (SELECT host, score FROM f WHERE kind = 'trust') a ON a.host = j.host
       LEFT JOIN (SELECT host, score FROM f WHERE kind = 'distrust') b ON b.host = j.host
"""
