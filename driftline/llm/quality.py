"""Quality scores by a generalised additive model with pairwise interactions.

Cyclic boosting: in each round every feature in turn gets one shallow tree (two levels, so up to four leaves) on the
gradient of the logistic loss, added with a small rate to that feature's lookup table. Then the pairs of features whose
coarse two-way table explains most of what is left are boosted in the same way, by trees that cut once on either
feature. A score is the intercept plus one table value a feature and pair: vectorised additions by bin.

Inputs are the figures of ``textstats`` alone. Labels come only from rows whose crc32(doc_id as text) mod 3 is not 1; at
most ``MOST_ROWS`` of them (those with the smallest hash of the id) are used to fit. Null or empty texts are scored
from zeros. Labels that are null are not used; a doc_id that is labelled twice counts once, with its larger label; of
the documents of a doc_id that repeats, the one whose text has the smallest hash is used to fit.
Without two kinds of labels the score is the share of label 1, or 0.5 without any. A null doc_id counts as the text "". An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import textstats, words

MOST_ROWS = 20_000
BINS, COARSE, ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 48, 8, 150, 60, 8, 0.1


def remainder(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Step for each bin from the sums of gradients and weights by bin: the best cut, and the best cut on each side."""

    def best(lo: int, hi: int) -> int | None:
        if hi - lo < 2:
            return None
        cg, ch = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
        tg, th = g[lo:hi].sum(), h[lo:hi].sum()
        gain = cg**2 / (ch + 1) + (tg - cg) ** 2 / (th - ch + 1)
        gain = np.where((ch > 1) & (th - ch > 1), gain, -1)
        k = int(np.argmax(gain))
        return lo + k + 1 if gain[k] > tg**2 / (th + 1) + 1e-9 else None

    edges = [0, len(g)]
    if first := best(0, len(g)):
        edges = sorted({0, len(g), first, *(c for c in (best(0, first), best(first, len(g))) if c)})
    step = np.zeros(len(g))
    for lo, hi in zip(edges, edges[1:], strict=False):
        step[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best step table that cuts once on either axis, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    tg, th = cg[-1, -1], ch[-1, -1]
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    parts = [(a, b), (cg[:-1, -1:] - a, ch[:-1, -1:] - b), (cg[-1:, :-1] - a, ch[-1:, :-1] - b)]
    parts.append((tg - sum(x for x, _ in parts), th - sum(y for _, y in parts)))
    gain = sum(x**2 / (y + 1) for x, y in parts)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    step = np.zeros_like(g)
    for k, (rows, cols) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        step[rows, cols] = parts[k][0][i, j] / (parts[k][1][i, j] + 1)
    return step, float(gain[i, j] - tg**2 / (th + 1))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Model of labels y (0 or 1) on the rows of x."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        return {"base": float(np.log((share + 1e-3) / (1 - share + 1e-3))) if len(y) else 0.0, "cuts": [], "coarse": [], "tables": [], "pairs": []}
    d = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, COARSE + 1)[1:-1])) for j in range(d)]
    bins = [np.searchsorted(cuts[j], x[:, j], "right") for j in range(d)]
    wide = [np.searchsorted(coarse[j], x[:, j], "right") for j in range(d)]
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    tables = [np.zeros(len(c) + 1) for c in cuts]
    score = np.full(len(y), base)

    def grad() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = grad()
            step = RATE * _tree(np.bincount(bins[j], g, len(tables[j])), np.bincount(bins[j], h, len(tables[j])))
            tables[j] += step
            score += step[bins[j]]
    g, h = grad()
    gains = []

    def two_way(a: int, b: int, v: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(wide[a] * shape[1] + wide[b], v, shape[0] * shape[1]).reshape(shape)

    for a in range(d):
        for b in range(a + 1, d):
            if len(coarse[a]) and len(coarse[b]):
                gains.append((_quadrants(two_way(a, b, g), two_way(a, b, h))[1], a, b))
    pairs = {(a, b): np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for _, a, b in sorted(gains, reverse=True)[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in pairs.items():
            g, h = grad()
            step = RATE * _quadrants(two_way(a, b, g), two_way(a, b, h))[0]
            table += step
            score += step[wide[a], wide[b]]
    return {"base": base, "cuts": cuts, "coarse": coarse, "tables": tables, "pairs": [(a, b, t) for (a, b), t in pairs.items()]}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), model["base"])
    for j, (cut, table) in enumerate(zip(model["cuts"], model["tables"], strict=True)):
        out += table[np.searchsorted(cut, x[:, j], "right")]
    for a, b, table in model["pairs"]:
        out += table[np.searchsorted(model["coarse"][a], x[:, a], "right"), np.searchsorted(model["coarse"][b], x[:, b], "right")]
    return 1 / (1 + np.exp(-out))


def _figures(it):
    for b in (s for x in it for s in words.batches([x])):
        x = textstats.features(words.blobs(b.column(1)))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])


def labelled(labels: DataFrame, column: str, most: int) -> DataFrame:
    """At most ``most`` labelled ids, those with the smallest hash: doc_id and label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model from the bounded sample; the sampled ids (two numbers each) are broadcast, their figures collected."""
    ids = labelled(labels.where(remainder(F.col("doc_id")) != 1), "quality", MOST_ROWS)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    rows = own.select(F.struct("doc_id", "label", F.xxhash64("text").alias("tie")).alias("doc_id"), "text").mapInArrow(_figures, "doc_id struct<doc_id long, label int, tie long>, x array<double>")
    # one row an id, that of the text with the smallest hash, so that no more than MOST_ROWS are collected however often ids repeat
    got = rows.select("doc_id.*", "x").groupBy("doc_id").agg(F.min(F.struct("tie", "x", "label")).alias("r")).select("doc_id", "r.x", "r.label").toPandas().sort_values("doc_id")
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(textstats.NAMES))
    order = np.lexsort((*x.T, got["doc_id"].to_numpy()))
    return fit(x[order], got["label"].to_numpy(float)[order])


def _score(model):
    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            p = score(model.value, textstats.features(words.blobs(b.column(1))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])

    return run


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and score of each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(model), "doc_id long, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", (remainder(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
