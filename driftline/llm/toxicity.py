"""Toxicity by a classifier chain: categories are predicted in a fixed order, each by a linear model that also sees the
probabilities of the categories before it.

Categories, from the columns of ``labels``: junk (quality is 0), toxic (toxic is 1), toxic_junk (both). A document is
toxic if the chain's probability of ``toxic`` is at least ``LEAST``.

Inputs of each model: which of the chosen words, four- and five-letter word beginnings a text holds; the figures of ``textstats``; the log
odds of earlier categories. While training, these odds are out-of-fold predictions (``FOLDS`` folds by hash of the
doc_id), so that a later model meets odds as good as those it will be given; afterwards each model is fitted on all
training rows. At most ``MOST_ROWS`` labelled rows, those with the smallest hash of the id, are used; the words are chosen there by
chi-squared for either label, at least ``LEAST_DOCS`` documents holding them.

Null texts and texts without words have the probability 0 of everything. A doc_id that is labelled twice counts once, with its larger
labels; of the documents of a doc_id that repeats, the one whose text has the smallest hash is used to fit; null labels count as not given. Where a category has no examples of either kind its probability is their share,
or 0 without labels, so nothing is toxic. An empty table gives an empty result; other columns are ignored, and
kept by ``clean``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import store, textstats, words

MOST_ROWS, LEAST_DOCS, CHOSEN, FOLDS, LEAST = 20_000, 3, 1500, 5, 0.5
CHAIN = ("junk", "toxic", "toxic_junk")

_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> set[str]:
    """Words of a text in lower case, and their beginnings (marked by a final *)."""
    own = set(_WORD.findall(text.lower()))
    return own | {w[:n] + "*" for w in own for n in (4, 5) if len(w) > n}


def _holds(it):
    for b in (s for x in it for s in words.batches([x])):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sorted(terms(t or "")) for t in b.column(1).to_pylist()], pa.list_(pa.string()))], names=["row", "terms"])


class _Known(dict):
    """Places of the chosen terms that each word stands for."""

    def __init__(self, places: dict[str, int]):
        super().__init__()
        self.places = places

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= words.MEMO:
            self.clear()
        got = self[word] = tuple(p for t in (word, *(word[:n] + "*" for n in (4, 5) if len(word) > n)) if (p := self.places.get(t)) is not None)
        return got


def sparse(texts: list[str | None], known: _Known) -> list[list[int]]:
    return [sorted({p for w in set(_WORD.findall((t or "").lower())) for p in known[w]}) for t in texts]


class Rows:
    """Rows of presence columns in compressed form, with dense columns beside them."""

    def __init__(self, held: list[list[int]], dense: np.ndarray, width: int):
        self.col = np.fromiter((p for h in held for p in h), np.int64)
        self.row = np.repeat(np.arange(len(held)), [len(h) for h in held])
        self.dense, self.width, self.n = dense, width, len(held)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n) + self.dense @ w[self.width :]

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.col, r[self.row], self.width), r @ self.dense])

    def take(self, keep: np.ndarray, dense: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        at = np.cumsum(keep) - 1
        use = keep[self.row]
        out.col, out.row, out.dense, out.width, out.n = self.col[use], at[self.row[use]], dense[keep], self.width, int(keep.sum())
        return out


def logistic(x: Rows, y: np.ndarray, penalty: float = 0.3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept with a squared penalty, by accelerated gradient steps scaled by column."""
    share = float(y.mean()) if len(y) else 0.0
    w, b = np.zeros(x.width + x.dense.shape[1]), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if not len(y) or y.min() == y.max():
        return w, b if len(y) else -20.0
    curve = 0.25 * (np.concatenate([np.bincount(x.col, minlength=x.width), (x.dense**2).sum(0)])) + penalty
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, steps + 1):  # Adam, on gradients scaled by the curvature of each column
        r = 1 / (1 + np.exp(-np.clip(x.dot(w) + b, -30, 30))) - y
        g = np.concatenate([(x.back(r) + penalty * w) / curve, [r.mean() * 4]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6) * min(1, 3 * (1 - k / (steps + 1)))
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(held: list[list[int]], figures: np.ndarray, labels: dict[str, np.ndarray], fold: np.ndarray, width: int) -> dict:
    """The chain, in the order of ``labels``. Presence columns count ``width``."""
    mean, scale = (figures.mean(0), figures.std(0) + 1e-9) if len(figures) else (np.zeros(figures.shape[1]), np.ones(figures.shape[1]))
    dense = np.clip((figures - mean) / scale, -3, 3)
    x, chain = Rows(held, dense, width), []
    for name, y in labels.items():
        chain.append((name, *logistic(x.take(np.ones(x.n, bool), dense), y)))
        odds = np.zeros(x.n)
        for k in range(FOLDS):
            own = fold == k
            w, b = logistic(x.take(~own, dense), y[~own])
            odds[own] = x.take(own, dense).dot(w) + b
        dense = np.column_stack([dense, np.clip(odds, -10, 10) / 5])
        x.dense = dense
    return {"mean": mean, "scale": scale, "chain": chain, "width": width}


def predict(model: dict, held: list[list[int]], figures: np.ndarray) -> dict[str, np.ndarray]:
    x, out = Rows(held, np.clip((figures - model["mean"]) / model["scale"], -3, 3), model["width"]), {}
    for name, w, b in model["chain"]:
        odds = x.dot(w) + b
        out[name] = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        x.dense = np.column_stack([x.dense, np.clip(odds, -10, 10) / 5])
    return out


def _examples(places):
    def run(it):
        known = _Known(places.value)
        for b in (s for x in it for s in words.batches([x])):
            held = sparse(b.column(1).to_pylist(), known)
            figures = textstats.features(words.blobs(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held, pa.list_(pa.int64())), pa.array(list(figures), pa.list_(pa.float64()))], names=["row", "held", "figures"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> dict:
    """The model and its terms, from a bounded sample: its ids are broadcast, counts of terms are made by Spark, and
    the chosen terms' places in each sampled row are collected."""
    spark = docs.sparkSession
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    ids = ids.agg(F.max(F.col("toxic").cast("int")).alias("toxic"), F.coalesce(F.min((F.col("quality") == 0).cast("int")), F.lit(0)).alias("junk"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_ROWS)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    # one text an id, that with the smallest hash, so that no more than MOST_ROWS are used however often ids repeat
    own = own.groupBy("doc_id", "toxic", "junk").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    own = store.settle(own.select(F.struct("doc_id", "toxic", "junk").alias("row"), "text"), "sample")
    kind = own.schema["row"].dataType.simpleString()
    counted = own.mapInArrow(_holds, f"row {kind}, terms array<string>").select("row.*", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"), F.sum("junk").alias("j")).where(F.col("n") >= LEAST_DOCS)
    total, t, j = own.select("row.*").agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("junk"), F.lit(0))).first()

    def chi(seen: str, positives: int):
        expected = F.col("n") * (positives / max(total, 1))
        return F.pow(F.col(seen) - expected, 2) / (expected * (1 - positives / max(total, 1)) + 1e-9)

    best = counted.withColumn("chi", F.greatest(chi("t", t), chi("j", j) / 4)).orderBy(F.desc("chi"), "term").limit(CHOSEN).select("term").collect()
    places = {r[0]: k for k, r in enumerate(best)}
    got = own.mapInArrow(_examples(spark.sparkContext.broadcast(places)), f"row {kind}, held array<bigint>, figures array<double>").select("row.*", "held", "figures").toPandas()
    got = got.sort_values("doc_id")
    toxic, junk = got["toxic"].to_numpy(float), got["junk"].to_numpy(float)
    fold = (got["doc_id"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % FOLDS
    figures = np.array(got["figures"].tolist(), float).reshape(len(got), len(textstats.NAMES))
    model = fit([list(h) for h in got["held"]], figures, dict(zip(CHAIN, (junk, toxic, toxic * junk), strict=True)), fold, len(places))
    return model | {"places": places}


def _predict(model, names, keep):
    def run(it):
        m = model.value
        known = _Known(m["places"])
        for b in (s for x in it for s in words.batches([x])):
            text = b.column(names.index("text")).cast(pa.string())
            texts = text.to_pylist()
            p = predict(m, sparse(texts, known), textstats.features(words.blobs(text)))
            none = np.array([_WORD.search(t or "") is None for t in texts], bool)
            for own in p.values():
                own[none] = 0
            if keep:
                yield b.filter(pa.array(p["toxic"] < LEAST))
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[c]) for c in CHAIN), pa.array(p["toxic"] >= LEAST)], names=["doc_id", *(f"p_{c}" for c in CHAIN), "toxic"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_junk, p_toxic, p_toxic_junk and toxic (boolean) of each row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model, ["doc_id", "text"], False), "doc_id long, " + ", ".join(f"p_{c} double" for c in CHAIN) + ", toxic boolean")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without its toxic rows, all columns kept."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    return docs.mapInArrow(_predict(model, docs.columns, True), docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go. It is trained on the labelled ones among docs."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
