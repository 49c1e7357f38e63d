"""Removal of long word sequences that an earlier document also has, by level-wise doubling.

Words are runs between ASCII white space, unchanged. A window is ``LENGTH`` (50) consecutive words of one document; each
word covered by a window whose sequence also starts in a document with a smaller doc_id goes. Windows are judged on the
input. Null text has no words. Rows with a null doc_id count as later than all others, and not as earlier or later than
each other. Rows that repeat a doc_id are judged each on its own text. An empty table gives an empty result; other
columns are ignored.

Plan. (1) One scan hashes the windows of the first level (with ``levels`` = 2: 13 words). Every window of 50 holds 38 of
these, and the smallest hash of the 38 is kept: equal windows keep equal hashes, so nothing is lost, and about one hash in
nineteen words leaves the scan. (2) Only hashes that occur in two documents survive; the windows around them alone are extended to
twice the length (25) and, where those survive too, to the full 50, or until no candidates survive. (3) Full windows have names of 128
bits and one row a document, however often they recur in it. The smallest doc_id per name is
pre-aggregated and joined back; equal texts are settled before that by their whole word sequence, so that copies are not
cut into windows at all. Names with very many rows, a bounded number of them, are met by broadcast, so no task gets all rows of one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import store, words

LENGTH = 50
LAST = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def steps(length: int, levels: int) -> list[int]:
    """Window lengths in ascending order: each is covered by two windows of the one before."""
    out = [length]
    for _ in range(levels):
        out.insert(0, (out[0] + 1) // 2)
    return out


def floor_of(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` successive values."""
    done, have = h, 1
    while have < width:
        step = min(have, width - have)
        done = np.minimum(done[: len(done) - step], done[step:])
        have += step
    return done


def _key(own: np.ndarray) -> bytes:
    at = np.arange(len(own), dtype=np.uint64)
    return np.array([words.mix(own + words.mix(at)).sum(), words.mix((own ^ np.uint64(0x5851F42D4C957F2D)) * (at * np.uint64(2) + np.uint64(1))).sum()], np.uint64).tobytes()


def _short(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _names(own: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window of length words from at on: two hashes of independent forms of the words' hashes."""
    return words.windows(own, length)[at], words.windows(words.mix(own ^ np.uint64(0x5851F42D4C957F2D)), length)[at]


def _first(length: int, level: int):
    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            split = [words.spaced(t, lower=False) for t in words.blobs(b.column(1))]
            flat, off = words.hashes(split)
            keys, shas, anchors = [], [], []
            for i, w in enumerate(split):
                own = flat[off[i] : off[i + 1]]
                keys.append(_key(own))
                shas.append(hashlib.sha256(b" ".join(w)).hexdigest())
                anchors.append(np.unique(floor_of(words.windows(own, level), length - level + 1)).view(np.int64) if len(own) >= length else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array([_short(k) for k in keys], pa.int64()), pa.array(np.diff(off), pa.int64()), pa.array(shas), pa.array(anchors, pa.list_(pa.int64()))],
                names=["ord", "key", "k8", "n", "sha", "anchors"],
            )

    return run


def _extend(length: int, level: int, target: int):
    """Windows of ``target`` words that hold a surviving window of ``level`` words; below the full length, again the
    smallest hash among those that each full window holds."""

    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            split = [words.spaced(t, lower=False) for t in words.blobs(b.column(1))]
            flat, off = words.hashes(split)
            live = b.column(2).to_pylist()
            wanted = b.column(3).to_pylist()
            ords, k8, texts, starts, hashes = [], [], [], [], []
            for i in range(b.num_rows):
                own = flat[off[i] : off[i + 1]]
                if len(own) < length or (k := _short(_key(own))) != wanted[i]:
                    continue
                low = floor_of(words.windows(own, level), length - level + 1)
                at = np.flatnonzero(np.isin(low.view(np.int64), np.array(live[i], np.int64)))
                if len(at):
                    ords.append(b.column(0)[i].as_py())
                    k8.append(k)
                    texts.append(b.column(1)[i].as_py())
                    if target < length:
                        hashes.append(np.unique(floor_of(words.windows(own, target), length - target + 1)[at]).view(np.int64))
                        starts.append(None)
                    else:  # a window that recurs in the document is one entry with all of its starts
                        names = _names(own, at, length)
                        by = np.lexsort(names)
                        first = np.flatnonzero(np.concatenate([[True], (np.diff(names[0][by]) != 0) | (np.diff(names[1][by]) != 0)]))
                        hashes.append([a.tobytes() + b.tobytes() for a, b in zip(names[0][by[first]], names[1][by[first]], strict=True)])
                        starts.append([x.astype(np.int32) for x in np.split(at[by], first[1:])])
            kind = pa.int64() if target < length else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ords, pa.int64()), pa.array(k8, pa.int64()), pa.array(texts, pa.string()), pa.array(starts, pa.list_(pa.list_(pa.int32()))), pa.array(hashes, pa.list_(kind))],
                names=["ord", "k8", "text", "starts", "hashes"],
            )

    return run


def _keep(length: int):
    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            removed, shas, kept = [], [], []
            for text, starts in zip(words.blobs(b.column(2)), b.column(3).to_pylist(), strict=True):
                w = words.spaced(text, lower=False)
                edge = np.zeros(len(w) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, np.array(starts) + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                left = b" ".join(w[i] for i in np.flatnonzero(~gone))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(shas), pa.array(kept)], names=["ord", "k8", "n_removed", "kept_sha256", "kept"])

    return run


def _shared(rows: DataFrame) -> DataFrame:
    """Hashes (h) that occur in two documents, settled, with the smallest doc_id and the number of their rows."""
    return store.settle(rows.groupBy("h").agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count(F.lit(1)).alias("c")).where("lo < hi").drop("hi"), "shared")


def repeats(docs: DataFrame, length: int = LENGTH, levels: int = 2) -> tuple[DataFrame, DataFrame]:
    """(all, changed). all: ord, doc_id, key, k8, n, sha and first (smallest ord with that word sequence) of each row;
    changed: ord, k8, n_removed, kept_sha256 and kept (the words that stay) of those that lose some but not by being a
    copy of a whole earlier document."""
    lengths = steps(length, levels)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"), F.col("text").cast("string").alias("text"))
    known = store.settle(texts.mapInArrow(_first(length, lengths[0]), "ord long, key binary, k8 long, n long, sha string, anchors array<long>"), "sequences")
    first = known.groupBy("key").agg(F.min("ord").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    known = store.meet(known, store.settle(first, "copies"), "key", "c", "left").withColumn("first", F.coalesce("first", "ord")).drop("c")
    heads = known.where((F.col("ord") == F.col("first")) & (F.col("n") >= length)).select("ord", "k8", F.explode("anchors").alias("h"))
    rows, pool = store.settle(heads.distinct(), "level"), texts
    for level, target in zip(lengths, lengths[1:], strict=False):
        live = store.meet(rows, _shared(rows), "h", "c").groupBy("ord", "k8").agg(F.collect_set("h").alias("live"))
        kind = "array<long>" if target < length else "array<binary>"
        found = pool.join(live, ["ord"] if pool is texts else ["ord", "k8"]).select("ord", "text", "live", "k8").mapInArrow(_extend(length, level, target), f"ord long, k8 long, text string, starts array<array<int>>, hashes {kind}")
        pool = store.settle(found, "level")
        if target < length:
            rows = pool.select("ord", "k8", F.explode("hashes").alias("h"))
    rows = pool.select("ord", "k8", F.explode(F.arrays_zip("hashes", "starts")).alias("w")).select("ord", "k8", F.col("w.hashes").alias("h"), F.col("w.starts").alias("at"))
    hits = store.meet(rows, _shared(rows), "h", "c").where("ord > lo").groupBy("ord", "k8").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"))
    changed = pool.select("ord", "k8", "text").dropDuplicates(["ord", "k8"]).join(hits, ["ord", "k8"]).select("ord", "k8", "text", "at").mapInArrow(_keep(length), "ord long, k8 long, n_removed long, kept_sha256 string, kept string")
    return known, changed


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, changed = repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    copy = (F.col("first") < F.col("ord")) & (F.col("n") >= LENGTH)
    out = known.join(changed.drop("kept"), ["ord", "k8"], "left")
    return out.select(
        F.when(F.col("ord") != LAST, F.col("ord")).alias("doc_id"),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
