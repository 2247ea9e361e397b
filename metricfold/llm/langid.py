"""Language identification by hierarchical discrimination.

The language family is predicted first, by one-versus-one linear support
vector machines between families; machines between the languages of that
family then separate them. Families are learned: the languages' mean features in
the training set are merged, the two groups with the closest means (by cosine,
over the average of their pairs) first, until as many groups are left as the
square root of the languages. So close languages meet in one family, whatever
they are called. Features are hashed 2- to 4-grams of the letters of
the whole text (case folded for ASCII and Latin-1, other characters as spaces),
as square roots of counts scaled to unit length.

Machines are fitted on about SAMPLE labelled documents of each language, drawn
by a hash of the id: the documented bound of the training set. Each machine is
trained in a task of its own, by dual coordinate descent; a language's mean in
one as well. With L languages in about sqrt(L) families there are about
L * sqrt(L) / 2 machines of DIM weights; the model travels to each worker once.
Prediction reads only the text and runs over every document whole.

Defined results: a text that is null or has no letter is ``und`` with score 0;
documents with null id or null lang teach nothing; without any labelled
document every prediction is ``und``; with one language that is predicted with
score 1. Ties between machines go to the smaller name. Repeated rows are
predicted one by one. Extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricfold.llm.common import Scratch, prepare

#: Training documents of a language, about.
SAMPLE = 1000
DIM = 1 << 14
EPOCHS = 8
COST = 10.0
BLOCK = 1 << 20  # bytes of text turned to features at a time
_FOLD = np.array([b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)
_ODD = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)


def group_families(means: dict[str, np.ndarray]) -> dict[str, str]:
    """The family of each language, named after its smallest member."""
    names = sorted(means)
    x = np.stack([means[n] / (np.linalg.norm(means[n]) or 1.0) for n in names]) if names else np.zeros((0, DIM))
    near, groups = x @ x.T, [[i] for i in range(len(names))]
    while len(groups) > max(1, math.ceil(math.sqrt(len(names)))):
        _, a, b = max((near[np.ix_(groups[a], groups[b])].mean(), -a, -b) for a, b in combinations(range(len(groups)), 2))
        groups[-a] = sorted(groups[-a] + groups[-b])
        del groups[-b]
    return {names[i]: names[g[0]] for g in groups for i in g}


def features(text: bytes) -> np.ndarray | None:
    """The feature vector, or None for a text without letters."""
    counts = np.zeros(DIM, np.int64)
    for at in range(0, len(text), BLOCK):
        b = _FOLD[np.frombuffer(text, np.uint8, min(BLOCK, len(text) - at), at)]
        if b.max(initial=0) >= 0xC3:  # Latin-1 capitals are two bytes, C3 80 to C3 9E
            cap = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)) + 1
            b[cap] += 32
        gap = b == 32
        b = b[~(gap & np.append(True, gap[:-1]))].astype(np.uint32)
        if len(b) < 2:
            b = np.append(b, np.uint32(32))
        h = b * np.uint32(_ODD[0])
        for n in range(1, 4):
            if len(b) <= n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(_ODD[n]) + b[n:] * np.uint32(_ODD[0])
            counts += np.bincount(((h ^ (h >> np.uint32(13))) * np.uint32(_ODD[3])) >> np.uint32(18), minlength=DIM)
    if not has_letter(text):
        return None
    x = np.sqrt(counts.astype(np.float32))
    return x / np.linalg.norm(x)


def has_letter(text: bytes) -> bool:
    b = np.frombuffer(text, np.uint8)
    low = b | 32
    if ((low >= 97) & (low <= 122)).any():
        return True
    return bool((b >= 128).any()) and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, epochs: int = EPOCHS, cost: float = COST):
    """Weights and bias of a linear machine over sparse rows (index, value), by
    dual coordinate descent on the hinge loss; side is +1 or -1. Classes weigh
    alike however many rows they have."""
    w, bias = np.zeros(DIM, np.float64), 0.0
    alpha = np.zeros(len(rows))
    share = {s: len(side) / (2 * max(1, (side == s).sum())) for s in (1, -1)}
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index, value = rows[i]
            margin = side[i] * (w[index] @ value + bias) - 1
            new = min(max(alpha[i] - margin / 2, 0.0), cost * share[side[i]])  # |x|^2 + 1 = 2
            if new != alpha[i]:
                step = (new - alpha[i]) * side[i]
                w[index] += step * value
                bias += step
                alpha[i] = new
    return w, bias


def _sparse(batches):
    for batch in batches:
        index, value = [], []
        for text in batch.column(1):
            x = features(text.as_py())
            at = np.flatnonzero(x) if x is not None else np.empty(0, np.int64)
            index.append(at.astype(np.int32))
            value.append(x[at] if x is not None else np.empty(0, np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.list_(pa.int32())),
                                          pa.array(value, pa.list_(pa.float32()))], names=["lang", "index", "value"])


def _train(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("key")
    rows = [(np.asarray(i), np.asarray(v, np.float64)) for i, v in zip(pdf["index"], pdf["value"])]
    w, bias = fit(rows, pdf["side"].to_numpy())
    return pd.DataFrame({"task": [pdf["task"].iloc[0]], "bias": [bias], "weights": [w.astype(np.float32).tobytes()]})


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(DIM)
    for index, value in zip(pdf["index"], pdf["value"]):
        total[np.asarray(index)] += np.asarray(value, np.float64)
    return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "mean": [(total / len(pdf)).tobytes()]})


class Model:
    """Machines by (level, one, other): a positive margin speaks for ``one``."""

    def __init__(self, families: dict[str, str], machines: dict[str, tuple[np.ndarray, float]]):
        self.langs = sorted(families)
        self.family = families
        self.families = sorted(set(families.values()))
        self.names = sorted(machines)
        self.weights = np.stack([machines[k][0] for k in self.names]) if machines else np.zeros((0, DIM), np.float32)
        self.biases = np.array([machines[k][1] for k in self.names])
        self.at = {k: i for i, k in enumerate(self.names)}

    def _choose(self, level: str, names: list[str], margins: np.ndarray) -> tuple[str, float]:
        votes = {x: [0, 0.0] for x in names}
        sure = {x: 1.0 for x in names}
        for one, other in combinations(names, 2):
            m = float(margins[self.at[task_name(level, one, other)]])
            win, lose = (one, other) if m >= 0 else (other, one)
            votes[win][0] += 1
            votes[win][1] += abs(m)
            votes[lose][1] -= abs(m)
            p = 1 / (1 + np.exp(-4 * m))
            sure[one], sure[other] = min(sure[one], p), min(sure[other], 1 - p)
        best = max(names, key=lambda x: (votes[x][0], votes[x][1], [-ord(c) for c in x]))
        return best, float(sure[best])

    def predict(self, text: bytes | None) -> tuple[str, float]:
        x = features(text) if text and self.langs else None
        if x is None:
            return "und", 0.0
        margins = self.weights @ x + self.biases
        group, p = self._choose("family", self.families, margins)
        lang, q = self._choose("language", [x for x in self.langs if self.family[x] == group], margins)
        return lang, min(1.0, p * q)


def task_name(level: str, one: str, other: str) -> str:
    return f"{level}\t{one}\t{other}"


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Model:
    """Fits the machines on a bounded sample of the labelled rows of docs."""
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "langid")
    known = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("binary").alias("text"),
                        F.col(lang_col).alias("lang")).where("key is not null and lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # languages
    langs = sorted(counts)
    if not langs:
        return Model({}, {})
    point = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.lit(0.0)
    for lang in langs:
        rate = F.when(F.col("lang") == lang, min(1.0, sample / counts[lang])).otherwise(rate)
    rows = scratch.table(known.where(point < rate).select(F.struct("key", "lang").alias("lang"), "text")
                         .mapInArrow(_sparse, "lang struct<key:string,lang:string>, index array<int>, value array<float>")
                         .where("size(index) > 0"), "features")
    given = rows.select(F.col("lang.key").alias("key"), F.col("lang.lang").alias("lang"), "index", "value")
    found = given.groupBy("lang").applyInPandas(_mean, "lang string, mean binary").collect()  # one for each language
    means = {lang: np.zeros(DIM) for lang in langs} | {r["lang"]: np.frombuffer(r["mean"]) for r in found}
    families = group_families(means)
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(families[lang], []).append(lang)
    sides = []
    for one, other in combinations(sorted(groups), 2):
        for s, name in ((1, one), (-1, other)):
            sides += [(task_name("family", one, other), x, s) for x in groups[name]]
    for members in groups.values():
        for one, other in combinations(sorted(members), 2):
            sides += [(task_name("language", one, other), one, 1), (task_name("language", one, other), other, -1)]
    machines = {}
    if sides:
        tasks = spark.createDataFrame(sides, "task string, lang string, side int")
        for r in given.join(F.broadcast(tasks), "lang").groupBy("task").applyInPandas(_train, "task string, bias double, weights binary") \
                .collect():  # one row for each machine and language joined, one for each machine here
            machines[r["task"]] = (np.frombuffer(r["weights"], np.float32), r["bias"])
    for level, one, other in {tuple(t.split("\t")) for t, _, _ in sides}:  # a side without letters taught nothing
        machines.setdefault(task_name(level, one, other), (np.zeros(DIM, np.float32), 0.0))
    return Model(families, machines)


def _predict(shared):
    def run(batches):
        model = shared.value
        for batch in batches:
            got = [model.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])
    return run


def held_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out (no part in training), lang_pred, score of every row."""
    taught = docs.where(~F.coalesce(held_out(id_col), F.lit(False)))
    model = train(taught, id_col, text_col, lang_col, sample)
    rows = docs.select(F.col(id_col), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), f"{id_col} {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = 0.5, **options) -> DataFrame:
    """The rows of docs whose language is found with min_score or more."""
    text_col = options.get("text_col", "text")
    id_col = options.get("id_col", "doc_id")
    taught = docs.where(~F.coalesce(held_out(id_col), F.lit(False)))
    model = train(taught, **options)
    predict = F.pandas_udf(_scores(docs.sparkSession.sparkContext.broadcast(model)), "double")
    return docs.where(predict(F.col(text_col).cast("binary")) >= min_score)


def _scores(shared):
    def scores(text: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.predict(t)[1] if t is not None else 0.0 for t in text], dtype="float64")
    return scores
