"""Benchmark decontamination with an FM-index of each shard of the corpus.

Words: A-Z lower-cased, then runs of letters a-z, digits and all non-ASCII code points. A window is ten consecutive
words of a benchmark item; an item of fewer words, but not none, is one window. A document word inside any occurrence
of a window is hit. Null texts have no words. Documents with a null or repeated doc_id are rows of their own. Items with a null item_id have windows that hit,
but no name to be listed under; an item_id that repeats names all of its rows. Empty tables give no rows or no hits.

Plan. The benchmark becomes blocks of windows of a bounded size (``BLOCK`` words a block; a block is shipped with each
task, so what a task holds does not grow with the benchmark). Each task cuts its documents into shards of about ``SHARD`` words
and maps every word outside the block's vocabulary to one separator; stretches too short for the shortest window are
dropped, since no window lies in them. The rest is indexed: suffix array by prefix doubling that refines only tied
suffixes, Burrows-Wheeler transform, wavelet tree with rank counts, and suffix positions sampled at every ``SAMPLE``-th
place. All windows are searched backwards at once, and their occurrences are located by steps to the next sample.
No shuffle. Of several blocks one is searched after the other, always in the input's texts: each pass adds its spans and
items beside the row, which is settled in between and needs no key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import store, words

WINDOW = 10
SHARD = 1 << 20
SAMPLE = 8
BLOCK = 2_000_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Wavelet:
    """Ranks of symbols in a sequence, by one bit vector with running counts for each bit of the alphabet."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        for shift in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((shift, ones))
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        begin = np.zeros_like(end)
        for (shift, ones), zeros in zip(self.levels, self.zeros, strict=True):
            bit = (symbol >> shift) & 1
            lo, hi = ones[begin], ones[end]
            begin, end = np.where(bit, zeros + lo, begin - lo), np.where(bit, zeros + hi, end - hi)
        return end - begin

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before that."""
        symbol, begin = np.zeros_like(place), np.zeros_like(place)
        for (_, ones), zeros in zip(self.levels, self.zeros, strict=True):
            bit = ones[place + 1] - ones[place]
            lo, hi = ones[begin], ones[place]
            begin, place = np.where(bit, zeros + lo, begin - lo), np.where(bit, zeros + hi, place - hi)
            symbol = symbol * 2 + bit
        return symbol, place - begin


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Order of all suffixes of seq (its last value is 0 and occurs nowhere else); ties alone are refined."""
    n = len(seq)
    width = max(1, int(seq.max()).bit_length())
    have = max(1, 62 // width)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([seq.astype(np.int64), np.zeros(have, np.int64)])
    for k in range(have):
        key = (key << width) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group is named by the place of its first suffix
    rank = np.empty(n, np.int64)
    rank[order] = group
    tied = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    while len(tied):
        own = order[tied]
        nxt = rank[np.minimum(own + have, n - 1)]
        g = group[tied]
        sub = np.lexsort((nxt, g))
        own, nxt = own[sub], nxt[sub]
        order[tied] = own
        fresh = np.concatenate([[True], (g[1:] != g[:-1]) | (nxt[1:] != nxt[:-1])])
        g2 = np.maximum.accumulate(np.where(fresh, tied, 0))
        group[tied] = g2
        rank[own] = g2
        tied = tied[~(fresh & np.concatenate([fresh[1:], [True]]))]
        have *= 2
    return order


class Index:
    """FM-index of a sequence of symbols from 1 up; 0 ends it."""

    def __init__(self, seq: np.ndarray):
        seq = np.concatenate([seq, [0]])
        order = suffix_array(seq)
        bwt = seq[order - 1]
        self.symbols = int(seq.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=self.symbols))])
        self.tree = Wavelet(bwt, self.symbols)
        marked = order % SAMPLE == 0
        self.marked = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each pattern; patterns are rows, their last word in the last column."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.first[-1], np.int64)
        for k in range(1, patterns.shape[1] + 1):
            use = np.flatnonzero((lengths >= k) & (lo < hi))
            c = patterns[use, -k]
            known = c < self.symbols
            lo[use[~known]] = hi[use[~known]] = 0
            use, c = use[known], c[known]
            lo[use], hi[use] = self.first[c] + self.tree.rank(c, lo[use]), self.first[c] + self.tree.rank(c, hi[use])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix, by steps back to the nearest sample."""
        at, steps, todo = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            hit = self.marked[rows[todo] + 1] > self.marked[rows[todo]]
            done = todo[hit]
            at[done] = self.sampled[self.marked[rows[done]]] + steps
            todo = todo[~hit]
            c, before = self.tree.at(rows[todo])
            rows[todo] = self.first[c] + before
            steps += 1
        return at


def phrases(items: list[tuple[str | None, bytes]], size: int) -> dict:
    """Vocabulary, distinct windows and, for each, the items it comes from; for one block of the benchmark."""
    vocab, found = {}, {}
    for name, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 2) for w in tokens(text)]  # 1 stands for all other words
        for i in range(max(1, len(ids) - size + 1) if ids else 0):
            found.setdefault(tuple(ids[i : i + size]), set()).add(name)
    lengths = np.array([len(p) for p in found], np.int64)
    patterns = np.zeros((len(found), size), np.int64)
    for row, p in enumerate(found):
        patterns[row, size - len(p) :] = p
    return {"vocab": vocab, "patterns": patterns, "lengths": lengths, "names": [sorted(x for x in s if x is not None) for s in found.values()]}


def matches(block: dict, split: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, window) of every occurrence in each document of one shard."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    out = [none] * len(split)
    vocab, lengths = block["vocab"], block["lengths"]
    if not len(lengths):
        return out
    n = np.array([len(w) for w in split], np.int64)
    off = np.concatenate([[0], np.cumsum(n + 1)])  # a separator after each document
    seq = np.ones(off[-1], np.int64)
    for i, w in enumerate(split):
        seq[off[i] : off[i + 1] - 1] = [vocab.get(x, 1) for x in w]
    # stretches of known words that are long enough for the shortest window, and one separator after each
    inside = np.concatenate([[0], (seq > 1).astype(np.int8), [0]])
    edge = np.flatnonzero(np.diff(inside))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= lengths.min()
    begin, end = begin[long], end[long]
    if not len(begin):
        return out
    size = end - begin + 1
    place = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    index = Index(seq[place])
    lo, hi = index.search(block["patterns"], lengths)
    got = np.flatnonzero(hi > lo)
    count = (hi - lo)[got]
    rows = np.repeat(lo[got] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    start, window = place[index.locate(rows)], np.repeat(got, count)
    by = np.argsort(start, kind="stable")
    start, window = start[by], window[by]
    cut = np.searchsorted(start, off)
    for i in np.flatnonzero(np.diff(cut)):
        out[i] = (start[cut[i] : cut[i + 1]] - off[i], window[cut[i] : cut[i + 1]])
    return out


def spans(start: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """Merged, in word places, end exclusive. start ascends."""
    out: list[list[int]] = []
    for s, e in zip(start.tolist(), (start + length).tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _search(blocks, last):
    """Adds one block's spans and items to those of earlier blocks; the last pass gives up the text for its n_words."""

    def run(it):
        ready = phrases(blocks.value, WINDOW)
        for b in (s for x in it for s in words.batches([x], 6 * SHARD)):
            split = [tokens(t) for t in words.blobs(b.column("text"))]
            hit, names = [], []
            for (start, window), spans_before, items_before in zip(matches(ready, split), b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                hit.append([y for x in _with(spans(start, ready["lengths"][window]), spans_before) for y in x])
                names.append(sorted({x for w in np.unique(window) for x in ready["names"][w]}.union(items_before or ())))
            found = pa.array(hit, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))
            if last:
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([len(w) for w in split], pa.int64()), *found], names=["row", "n_words", "spans", "items"])
            else:
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], *found], schema=b.schema)

    return run


def _blocks(benchmark: DataFrame):
    """Lists of (item_id as string, text), each of at most BLOCK words' worth of bytes (or one item)."""
    block, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        text = bytes(r[1] or b"")
        if block and size + len(text) > 6 * BLOCK:
            yield block
            block, size = [], 0
        block.append((r[0], text))
        size += len(text)
    yield block


def _with(found: list[tuple[int, int]], before: list[int] | None) -> list[tuple[int, int]]:
    """Spans merged with the flat ones of earlier blocks."""
    if not before:
        return found
    at = np.array(sorted([*found, *zip(before[::2], before[1::2], strict=True)]), np.int64)
    return spans(at[:, 0], at[:, 1] - at[:, 0])


def _passed(rows: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, list]:
    """rows with two more columns, the spans and items of all blocks but the last one, and that block."""
    spark, own = rows.sparkSession, "_" * (1 + max(len(c) for c in rows.columns))  # longer than any name there is
    rows = rows.select("*", F.lit(None).cast("array<long>").alias(f"{own}spans"), F.lit(None).cast("array<string>").alias(f"{own}items"))
    blocks, path = _blocks(benchmark), None
    block = next(blocks)
    for following in blocks:
        done, path = path, store.place(spark, "block")
        rows.mapInArrow(_search(spark.sparkContext.broadcast(block), False), rows.schema).write.option("compression", "zstd").parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        if done:
            store.remove(spark, done)
        block = following
    return rows, block


def contamination(docs: DataFrame, benchmark: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_words, spans (flat word places of the merged removal spans: start, end, start, end ...) and items (sorted
    item ids with occurring windows) of each row."""
    rows, block = _passed(docs.select(F.struct(*keys).alias("row"), F.col("text").cast("string").alias("text")), benchmark)
    kind = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, spans array<long>, items array<string>"
    return rows.mapInArrow(_search(rows.sparkSession.sparkContext.broadcast(block), True), kind).select("row.*", "n_words", "spans", "items")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"])
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of their removal spans; a document that keeps no word of its text is dropped.

    Text outside the spans keeps its characters; a span and what separates its words go. n_chars follows the text.
    """
    names = docs.columns
    rows, block = _passed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.mapInArrow(_cut(spark.sparkContext.broadcast(block), names), docs.schema)


def _cut(blocks, names):
    """The last pass: cuts each text once, by the spans of all blocks."""
    import re

    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = {c: c + 32 for c in range(65, 91)}

    def run(it):
        ready = phrases(blocks.value, WINDOW)
        at = names.index("text")
        for b in (s for x in it for s in words.batches([x], 6 * SHARD)):
            texts = b.column(at).to_pylist()
            found = matches(ready, [tokens(t) for t in words.blobs(b.column(at))])
            keep = []
            for i, ((start, window), before) in enumerate(zip(found, b.column(b.num_columns - 2).to_pylist(), strict=True)):
                keep.append(True)
                gone = _with(spans(start, ready["lengths"][window]), before)
                if gone:
                    places = [m.span() for m in word.finditer(texts[i].translate(lower))]
                    left, last = [], 0
                    for s, e in gone:
                        left.append(texts[i][last : places[s][0]])
                        last = places[e - 1][1]
                    left.append(texts[i][last:])
                    texts[i] = "".join(left)
                    keep[-1] = word.search(texts[i].translate(lower)) is not None
            cols = {"text": lambda c: pa.array(texts, c.type), "n_chars": lambda c: pa.array([None if t is None else len(t) for t in texts], c.type)}
            own = [cols[n](c) if n in cols else c for n, c in zip(names, b.columns[:-2], strict=True)]
            yield pa.RecordBatch.from_arrays(own, names=names).filter(pa.array(keep))

    return run
