"""Operator 10: toxicity categories by a classifier chain.

Categories are predicted one after the other. Each has a logistic model over
binary text features and over the log-odds of all earlier categories; in
training those come from out-of-fold predictions, so a later model sees the
earlier ones as uncertain as they will be on new texts.

Features of a text: its distinct lower-cased words, their first 4, 5 and 6
letters, and runs of symbols. For each category the ``FEATURES`` with the
largest chi-square over the training rows are used.

Fit: on a bounded sample of the labelled rows, the ``MAX_ROWS`` with the
smallest hash of their id (a documented parameter; the models' only input).
Feature counts are grouped in Spark; the driver gets the chosen features and,
for each sample row, which of them it has. Scoring reads every whole text.

Defined results: null and empty texts have no features and get the base rate;
rows without a label are not used for that category; without any labelled row
of both classes a category's probability is its base rate (0.5 without rows);
repeated rows each give their row; an empty table gives an empty one. In the
fit a repeated id counts once, with its smallest text and its largest labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 8000
FEATURES = 600
MIN_ROWS = 4
FOLDS = 4
L2 = 2e-3
STEPS = 150
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]{2,}|\|")
_memo: dict[str, tuple] = {}


def forms(word: str) -> list[str]:
    """A word's features: itself, and its beginnings marked with a star."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)]


def features(text: str | None) -> set[str]:
    return {f for w in set(_TOKEN.findall((text or "").lower())) for f in forms(w)}


@dataclass
class Link:
    """One category's model: weights of the features, then of the earlier log-odds."""
    name: str
    weights: np.ndarray
    bias: float
    threshold: float


@dataclass
class Chain:
    vocabulary: dict[str, int]
    links: list[Link]

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities (rows, categories) from the feature numbers of each row."""
        out = np.zeros((len(rows), len(self.links)))
        size = len(self.vocabulary)
        for c, link in enumerate(self.links):
            base = np.array([link.weights[r].sum() for r in rows]) if rows else np.zeros(0)
            out[:, c] = _sigmoid(base + link.bias + _odds(out[:, :c]) @ link.weights[size:])
        return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _odds(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = L2, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression, by accelerated gradient
    steps on columns scaled to equal size."""
    n, d = x.shape
    if not n:
        return np.zeros(d), 0.0
    if y.min() == y.max():
        return np.zeros(d), float(_odds(np.array([y.mean()]))[0])
    scale = np.sqrt((x.astype(np.float64) ** 2).mean(axis=0)) + 1e-3
    z = np.concatenate((x / scale.astype(np.float32), np.ones((n, 1), np.float32)), axis=1).astype(np.float32)
    v = np.ones(d + 1, np.float32)
    for _ in range(12):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * float(np.linalg.norm(z @ v) ** 2) / n * 1.05 + l2)
    ridge = np.full(d + 1, l2, np.float32)
    ridge[-1] = 0
    w = look = np.zeros(d + 1, np.float32)
    for t in range(1, steps + 1):
        new = look - step * (z.T @ (_sigmoid(z @ look) - y).astype(np.float32) / n + ridge * look)
        look = new + (t - 1) / (t + 2) * (new - w)
        w = new
    return w[:-1].astype(np.float64) / scale, float(w[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut on the out-of-fold probabilities with the best F1, halfway
    between neighbours; 0.5 without positives."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    if not len(y) or not hits[-1]:
        return 0.5
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    last = np.append(p[order][1:] < p[order][:-1], True)
    at = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((p[order][at] + below) / 2)


def fit_chain(vocabulary: list[str], rows: list[np.ndarray], labels: dict[str, np.ndarray], fold: np.ndarray) -> Chain:
    """``labels``: category -> 0/1, NaN where unknown, in the order of the chain."""
    x = np.zeros((len(rows), len(vocabulary)), np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    earlier, links = np.zeros((len(rows), 0), np.float32), []
    for name, y in labels.items():
        full = np.concatenate((x, earlier), axis=1)
        known = ~np.isnan(y)
        oof = np.full(len(rows), 0.5)
        for f in range(FOLDS):
            train = known & (fold != f)
            w, b = fit_logistic(full[train], y[train])
            oof[fold == f] = _sigmoid(full[fold == f] @ w + b)
        w, b = fit_logistic(full[known], y[known])
        links.append(Link(name, w, b, best_threshold(oof[known], y[known])))
        earlier = np.concatenate((earlier, _odds(oof)[:, None].astype(np.float32)), axis=1)
    return Chain({v: i for i, v in enumerate(vocabulary)}, links)


def fit(docs: DataFrame, labels: DataFrame, categories: dict, key: str = "doc_id", text: str = "text",
        max_rows: int = MAX_ROWS, per_category: int = FEATURES) -> Chain:
    """``categories``: name -> 0/1 column expression over ``labels``, in the order of the chain."""
    names = list(categories)
    cols = [e.cast("double") for e in categories.values()]
    known = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*[F.max(e).alias(f"_y{i}") for i, e in enumerate(cols)])
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(max_rows)  # at most max_rows narrow rows
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    ys = [f"_y{i}" for i in range(len(names))]
    sample = sample.groupBy("_key", *ys).agg(F.min("_text").alias("_text"))  # one row of each id, however often it is repeated
    schema = "_key long, _fold int, " + ", ".join(f"_y{i} double" for i in range(len(names))) + ", _f array<string>"
    n_y = len(names)

    def extract(batches):
        for batch in batches:
            f = [sorted(features(t)) for t in batch.column(1).to_pylist()]
            k = batch.column(0).cast(pa.int64())
            fold = pa.array([(int(v) * 2654435761 >> 7) % FOLDS for v in k.to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([k, fold, *(batch.column(2 + i) for i in range(n_y)), pa.array(f, pa.list_(pa.string()))],
                                             names=["_key", "_fold", *(f"_y{i}" for i in range(n_y)), "_f"])

    seen = sample.select("_key", "_text", *(f"_y{i}" for i in range(n_y))).mapInArrow(extract, schema).persist()
    try:
        sums = [F.count(F.lit(1)).alias("n")] + [a for i in range(n_y) for a in (F.sum(f"_y{i}").alias(f"p{i}"), F.count(f"_y{i}").alias(f"k{i}"))]
        whole = seen.agg(*sums).first()
        per = seen.select(F.explode("_f").alias("f"), *(f"_y{i}" for i in range(n_y))).groupBy("f").agg(*sums).filter(F.col("n") >= MIN_ROWS)
        vocabulary: list[str] = []
        for i in range(n_y):
            p, k = float(whole[f"p{i}"] or 0), float(whole[f"k{i}"] or 0)
            if not 0 < p < k:
                continue
            a, b = F.col(f"p{i}"), F.col(f"k{i}") - F.col(f"p{i}")
            inside = F.col(f"k{i}")
            chi = (a * (k - p) - b * p) ** 2 * k / (inside * (k - inside + 1e-9) * p * (k - p) + 1e-9)
            vocabulary += [r["f"] for r in per.filter(inside > 0).select("f", chi.alias("chi")).orderBy(F.desc("chi"), "f").limit(per_category).collect()]
        vocabulary = sorted(set(vocabulary))
        wanted = set(vocabulary)
        index = {v: i for i, v in enumerate(vocabulary)}
        small = seen.select("_key", "_fold", *(f"_y{i}" for i in range(n_y)), F.array_intersect("_f", F.lit(vocabulary) if vocabulary else F.array().cast("array<string>")).alias("_f"))
        got = sorted(small.collect(), key=lambda r: r["_key"])
    finally:
        seen.unpersist()
    rows = [np.array(sorted(index[f] for f in r["_f"] if f in wanted), np.int64) for r in got]
    y = {n: np.array([np.nan if r[f"_y{i}"] is None else r[f"_y{i}"] for r in got], np.float64) for i, n in enumerate(names)}
    return fit_chain(vocabulary, rows, y, np.array([r["_fold"] for r in got], np.int64))


def _numbers(text: str | None, index: dict[str, int]) -> np.ndarray:
    """The chosen features that a text has; a bounded memo keeps each word's."""
    if len(_memo) > 500_000 or _memo.get("") is not index:
        _memo.clear()
        _memo[""] = index  # held, so no other vocabulary can take its place
    out = set()
    for w in set(_TOKEN.findall((text or "").lower())):
        got = _memo.get(w)
        if got is None:
            got = _memo[w] = tuple(index[f] for f in forms(w) if f in index)
        out.update(got)
    return np.array(sorted(out), np.int64)


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, p_<category> and is_<category> for every category. The
    chain's size is bounded by ``FEATURES`` for each category."""
    src = docs.select(F.col(key), F.col(text).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    names = [link.name for link in chain.links]
    schema = T.StructType([src.schema.fields[0], *[T.StructField(f"p_{n}", T.DoubleType()) for n in names], *[T.StructField(f"is_{n}", T.BooleanType()) for n in names]])

    def run(batches):
        c = sent.value
        cut = np.array([link.threshold for link in c.links])
        for batch in batches:
            p = np.round(c.score([_numbers(t, c.vocabulary) for t in batch.column(1).to_pylist()]), 9)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, i]) for i in range(len(names))), *(pa.array(p[:, i] >= cut[i]) for i in range(len(names)))],
                                             names=schema.names)

    return src.mapInArrow(run, schema)
