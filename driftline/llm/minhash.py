"""Near-duplicate documents by MinHash: banding, signature check, exact check, components by alternating stars.

A text is lower-cased (A-Z only) and cut into words at ASCII white space. Its set holds the distinct shingles of five
words, or the whole sequence as one shingle if it has fewer words. Null or wordless texts have the empty set and are
linked with nothing. Two documents are linked if the Jaccard similarity of their full sets is at least 0.75.

doc_id names a document; rows that repeat one are one node, each with its own n_shingles, and the node's links are those
of its smallest text. Null doc_id: the row is kept, linked with
nothing, and its component_id is null. An empty table gives an empty result. Other columns are ignored.

Plan. (1) One scan gives each document its set size, a 128-bit key of the set, and 128 minima of universal hashes.
(2) Equal sets become one class, named by its smallest doc_id, so copies never meet in pairs. (3) The 32 bands of four
minima of each class are dealt by band key. In a bucket of at most ``SMALL`` classes each pair is a candidate (at most
SMALL / 2 a row). In a larger one, which may be a group of near copies as large as the corpus, each class is first compared
with two centres; what is then outside a bucket's largest component is compared with the rest of the bucket, signature by
signature in blocks, so no pair in different components is passed over, and those already connected cost nothing;
pairs that agree are confirmed inside the block and only links leave it. (4) Candidates
whose signatures agree in under ``AGREE`` of the places are dropped (a pair at 0.75 fails this about once in 10^5; it shares
no band about once in 2 * 10^5), and the others are confirmed on full sets, in blocks around one of the two. (5) Links become components by alternating
large-star and small-star steps, each settled in the shared checkpoint folder.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import store, words

ROWS, BANDS, WIDTH = 4, 32, 5
MINIMA = ROWS * BANDS
SMALL = 12
AGREE = 0.58
BLOCK = 48
SIDE = 512
#: Numerator and denominator of the least similarity of a link.
LEAST = (75, 100)

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, with repeats, of all texts in one array, and the n + 1 offsets of the texts in it."""
    split = [words.spaced(t, lower=True) for t in texts]
    flat, off = words.hashes(split)
    n = np.diff(off)
    size = np.where(n >= WIDTH, n - WIDTH + 1, (n > 0).astype(np.int64))
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(size, out=out[1:])
    full = words.windows(flat, WIDTH)
    place = np.repeat(off[:-1] - out[:-1], size) + np.arange(out[-1])
    if len(full):
        hashes = full[np.minimum(place, len(full) - 1)]
    else:
        hashes = np.zeros(len(place), np.uint64)
    for i in np.flatnonzero((n > 0) & (n < WIDTH)):
        own = flat[off[i] : off[i + 1]]
        hashes[out[i]] = words.windows(own, len(own))[0] ^ np.uint64(len(own))
    return hashes, out


def minima(hashes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """MINIMA smallest values of universal hashes of each text; texts without shingles get the largest value."""
    n = len(off) - 1
    out = np.full((n, MINIMA), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(off) > 0)
    first = 0
    while first < len(some):  # blocks that stay in the cache
        last = max(first + 1, int(np.searchsorted(off[some + 1], off[some[first]] + 65536)))
        rows = some[first:last]
        lo, hi = off[rows[0]], off[rows[-1] + 1]
        x, at = hashes[lo:hi], off[rows] - lo
        for k in range(MINIMA):
            out[rows, k] = np.minimum.reduceat((x * _A[k] + _B[k]) >> np.uint64(32), at)
        first = last
    return out


def _sketch(it):
    for b in (s for x in it for s in words.batches([x])):
        ids, texts = b.column(0), words.blobs(b.column(1))
        hashes, off = shingles(texts)
        sig = minima(hashes, off)
        size, key = [], []
        for i in range(len(texts)):
            own = np.unique(hashes[off[i] : off[i + 1]])
            size.append(len(own))
            key.append(np.array([len(own), words.mix(own).sum(), words.mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64).tobytes()[4:] if len(own) else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array([r.tobytes() for r in sig], pa.binary())], names=["doc_id", "n", "key", "sig"]
        )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), key (of the whole set; null if empty), sig (minima)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sketch, "doc_id long, n long, key binary, sig binary")


def _agree(it):
    for b in it:
        a, c = ([np.frombuffer(x, np.uint32) for x in b.column(i).to_pylist()] for i in (2, 3))
        if a:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array((np.stack(a) == np.stack(c)).mean(1) >= AGREE))


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, as ascending arrays, are similar enough for a link."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return LEAST[1] * both >= LEAST[0] * (len(x) + len(y) - both)


def _confirm(pdf: pd.DataFrame) -> pd.DataFrame:
    """The links among one block of a centre (role 0) and other classes (role 1)."""
    core = pdf[pdf["role"] == 0]
    rest = pdf[pdf["role"] == 1]
    if not len(core) or not len(rest):
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    hashes, off = shingles([x.encode() for x in (core["text"].iloc[0], *rest["text"])])
    centre = np.unique(hashes[: off[1]])
    keep = []
    for i in range(1, len(off) - 1):
        own = np.unique(hashes[off[i] : off[i + 1]])
        keep.append(_linked(own, centre))
    got = rest[np.array(keep, bool)]
    return pd.DataFrame({"a": got["a"].astype("int64"), "b": got["b"].astype("int64")})


def alike(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose signatures agree in AGREE of the places."""
    left, right = reps.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), reps.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    pairs = store.settle(pairs, "tried")
    both = store.beside(pairs, left, "a", store.hottest(pairs, "a"))
    both = store.beside(both, right, "b", store.hottest(pairs, "b"))
    return both.select("a", "b", "sa", "sb").mapInArrow(_agree, "a long, b long")


def _near(x: np.ndarray, y: np.ndarray, band: int) -> np.ndarray:
    """Rows of y whose signatures agree with x in AGREE of the places, and that share no band with it before this one:
    so each pair is looked at in one bucket only, and not at all if that is a small one."""
    same = y == x
    first = same.reshape(len(y), BANDS, ROWS).all(2).argmax(1)
    return (same.mean(1) >= AGREE) & (first == band)


def _grey(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block of minor classes and one of their bucket's classes: those that agree with one in another component."""
    minor, other = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
    hit, met = np.zeros(len(minor), bool), np.zeros(len(other), bool)
    if len(minor) and len(other):
        y, cy, band = np.stack([np.frombuffer(v, np.uint32) for v in other["sig"]]), other["component"].to_numpy(), int(pdf["b"].iloc[0])
        for k, (v, component) in enumerate(zip(minor["sig"], minor["component"], strict=True)):
            near = _near(np.frombuffer(v, np.uint32), y, band) & (cy != component)
            hit[k] = near.any()
            met |= near
    return pd.concat([minor[hit], other[met]])[["band", "b", "i", "j", "role", "rep", "component"]]


def _links(pdf: pd.DataFrame) -> pd.DataFrame:
    """The blocks of _grey again, now with texts: one exact link from each minor class to each component that it has
    links to, the likeliest pairs tried first."""
    minor, other = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
    a, b = [], []
    if len(minor) and len(other):
        hashes, off = shingles([x.encode() for x in (*minor["text"], *other["text"])])
        sig, sets = minima(hashes, off), [np.unique(hashes[s:e]) for s, e in zip(off, off[1:], strict=False)]
        n, band = len(minor), int(pdf["b"].iloc[0])
        ids, cy = other["rep"].to_numpy(), other["component"].to_numpy()
        for k, (rep, component) in enumerate(zip(minor["rep"], minor["component"], strict=True)):
            done = {component}
            near = np.flatnonzero(_near(sig[k], sig[n:], band))
            for m in near[np.argsort(-(sig[n + near] == sig[k]).sum(1), kind="stable")]:
                if cy[m] not in done and _linked(sets[k], sets[n + m]):
                    done.add(cy[m])
                    a.append(min(rep, ids[m]))
                    b.append(max(rep, ids[m]))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _across(crowded: DataFrame, found: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between classes that share a crowded bucket and lie in different components, settled: at least one from a class to each
    component that it has links to.

    Only what is outside a bucket's largest component is compared, with the rest of the bucket: signature by signature,
    in blocks of SIDE by SIDE. The classes that agree with another, not their pairs, then go through the same blocks
    with their texts, and pairs are confirmed there.
    """
    label = crowded.select("band", "b", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select("band", "b", "rep", F.coalesce("component", "rep").alias("component"))
    label = store.settle(label, "label")
    parts = label.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    split = parts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    split = split.select("band", "all", F.col("top.component").alias("top"), F.ceil(F.col("all") / SIDE).alias("others"), F.ceil((F.col("all") - F.col("top.n")) / SIDE).alias("minors"))
    rows = store.meet(label, store.settle(split, "split"), "band", "all").join(reps.select("rep", "sig"), "rep")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    one = lambda n: F.array(F.pmod(F.xxhash64("rep"), F.col(n)))
    dealt = lambda role, i, j: F.transform(i, lambda x: F.struct(F.lit(role).alias("role"), x.alias("i"), j.alias("j")))
    roles = F.concat(F.when(F.col("component") != F.col("top"), dealt(0, one("minors"), every("others"))).otherwise(F.array()), dealt(1, every("minors"), one("others")))
    both = rows.select("band", "b", "rep", "component", "sig", F.explode(roles).alias("d")).select("band", "b", "rep", "component", "sig", "d.role", "d.i", F.explode("d.j").alias("j"))
    kind = "band long, b int, i long, j long, role int, rep long, component long"
    grey = store.settle(both.groupBy("band", "i", "j").applyInPandas(_grey, kind), "grey")
    return store.settle(grey.join(texts, "rep").groupBy("band", "i", "j").applyInPandas(_links, "a long, b long").distinct(), "across")


def confirmed(likely: DataFrame, texts: DataFrame) -> DataFrame:
    """Those pairs (a, b), settled, whose full sets are similar enough. texts: rep and text, one row a class."""
    likely = store.settle(likely, "likely")
    # the members of one centre are dealt into blocks of about BLOCK; the centre's text goes to each of its blocks once
    sizes = store.settle(likely.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.count(F.lit(1)).alias("n")), "blocks")
    members = store.meet(likely, sizes, "a", "n").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"), F.lit(1).alias("role"), F.col("b").alias("rep"))
    cores = sizes.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"), F.col("a").alias("rep"))
    with_text = cores.unionByName(members).join(texts, "rep").select("a", "b", "block", "role", "text")
    return store.settle(with_text.groupBy("a", "block").applyInPandas(_confirm, "a long, b long"), "confirmed")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest reachable node) of each node of the links (a, b); alternating large and small stars.

    Every step is settled; a hot node's links are read through equi-joins that can be split, its minimum is
    pre-aggregated, and no node's links are gathered in one row. It ends when each node has one link, to a node that
    has none to a smaller one.
    """
    edges = store.settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = store.settle(large, "large")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = store.settle(small, "small")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether no node has two links to smaller ones, or one to a node that has such a link itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down = 1 and up = 1")
    return not odd.take(1)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (doc_id, text); see the module."""
    all_ = store.settle(sketches(docs), "sketches")
    classes = all_.where("key is not null and doc_id is not null").groupBy("key").agg(F.min(F.struct(F.col("doc_id").alias("rep"), "sig")).alias("x"), F.count(F.lit(1)).alias("copies"))
    reps = store.settle(classes.select("key", "x.rep", "x.sig", "copies"), "classes")
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(F.substring(F.col("sig"), i * (4 * ROWS) + 1, F.lit(4 * ROWS)), i))
    rows = reps.select("rep", F.posexplode(band).alias("b", "band"))
    sizes = store.settle(rows.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "sizes")
    buckets = store.settle(store.meet(rows, sizes, "band", "c").select("band", "rep", "b", "c"), "buckets")  # rows that share a bucket with another class
    few = buckets.where(F.col("c") <= SMALL).groupBy("band").agg(F.sort_array(F.collect_set("rep")).alias("r"))  # at most SMALL a row
    few = few.select(F.explode(F.flatten(F.transform("r", lambda x, i: F.transform(F.slice("r", i + 2, F.lit(SMALL)), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
    # a class that shares large buckets is like many others, and so a good centre
    crowded = buckets.where(F.col("c") > SMALL)
    weight = crowded.groupBy("rep").agg(F.sum("c").alias("w"))
    crowded = store.settle(crowded.join(weight, "rep"), "crowded")
    first = lambda *by: F.min(F.struct(*by, "rep"))["rep"]
    centres = crowded.groupBy("band").agg(F.array(first(-F.col("w")), first(F.xxhash64("rep"))).alias("centres"), F.count(F.lit(1)).alias("members"))
    tried = store.meet(crowded, store.settle(centres, "centres"), "band", "members").select("rep", F.explode("centres").alias("to")).where("rep <> to").select(*_pair("rep", "to"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    texts = store.settle(texts.join(buckets.select("rep").distinct(), "rep", "left_semi").groupBy("rep").agg(F.min("text").alias("text")), "texts")
    links = confirmed(alike(few.union(tried).distinct(), reps), texts)
    found = components(links)
    more = _across(crowded, found, reps, texts)
    if more.take(1):
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    labels = reps.select("key", "rep", "copies").join(found.withColumnRenamed("node", "rep"), "rep", "left").where("copies > 1 or component <> rep")
    labels = store.settle(labels.select("key", "copies", F.coalesce("component", "rep").alias("component")), "labels")  # all other rows are components of their own
    out = store.meet(all_.select("doc_id", "n", "key"), labels, "key", "copies", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def _pair(left: str, right: str):
    return F.least(left, right).alias("a"), F.greatest(left, right).alias("b")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; rows without id or words stay."""
    gone = near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone, docs["doc_id"] == gone["doc_id"], "left_anti")
