"""The registered queries and the pipeline, over whole tables of the smallest scale."""

import hashlib
import math
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from driftline.llm import mixing, registry, tokenstore, toxicity

SF = "/root/testdata/sf0.001"


def rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(spark, name):
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(c.sql(registry.ORACLE[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_one_row_a_document(spark, name):
    table = "pages" if name.startswith("op6") else "documents"
    assert registry.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


WORD, SPACED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def without_copies(docs):
    sets = {}
    for d, t, _ in docs:
        w = SPACED.findall(t.translate(LOWER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    low = {d: d for d in sets}
    moved = True
    links = [(a, b) for a in sets for b in sets if a < b and (n := len(sets[a] & sets[b])) and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            moved |= m != low[a] or m != low[b]
            low[a] = low[b] = m
    return [r for r in docs if low[r[0]] == r[0]]


def without_items(docs, items):
    wanted = set()
    for t in items:
        w = WORD.findall(t.translate(LOWER))
        wanted |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}
    out = []
    for d, t, s in docs:
        m = list(WORD.finditer(t.translate(LOWER)))
        w, hit = [x[0] for x in m], [False] * len(m)
        for n in {len(x) for x in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit[i : i + n] = [True] * n
        if any(hit):
            # two spans with nothing between them are cut as one
            gone = [False] * len(t)
            for i, h in enumerate(hit):
                if h:
                    end = m[i + 1].start() if i + 1 < len(hit) and hit[i + 1] else m[i].end()
                    gone[m[i].start() : end] = [True] * (end - m[i].start())
            t = "".join(c for c, g in zip(t, gone, strict=True) if not g)
            if not WORD.search(t.translate(LOWER)):
                continue
        out.append((d, t, s))
    return out


def mixed(docs):
    by = {}
    for r in docs:
        by.setdefault(r[2], []).append((len(SPACED.findall(r[1])), *r))
    size = {s: sum(r[0] for r in rs) for s, rs in by.items()}
    weight, full = {s: float((5, 2, 1)[i % 3]) for i, s in enumerate(sorted(by))}, set()
    while True:
        open_ = sorted(set(by) - full)
        rest = (sum(size.values()) - sum(3 * size[s] for s in full)) / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * rest > 3 * size[s]}
        if not above:
            break
        full |= above
    out = []
    for s, rs in by.items():
        rate = (3 * size[s] if s in full else weight[s] * rest) / size[s]
        at = int(hashlib.md5(f"{mixing.SEED}:{s}".encode()).hexdigest()[:8], 16) / 2**32
        for k, r in enumerate(sorted(rs), 1):
            out += [r[1:]] * (math.floor(k * rate + at) - math.floor((k - 1) * rate + at))
    return out


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    rude = {r.doc_id for r in toxicity.toxicity(read("documents"), read("labels")).where("toxic").collect()}
    marked = {r.doc_id for r in read("labels").where("toxic = 1").collect()}
    assert marked and len(rude & marked) >= 0.9 * len(marked)
    docs = [(r.doc_id, r.text, r.source) for r in read("documents").collect() if r.doc_id not in rude]
    docs = mixed(without_items(without_copies(docs), [r.text for r in read("benchmark").collect()]))
    tok, want, start = Tokenizer.from_file(tokenstore.tokenizer_path()), [], 0
    for d, t, _ in sorted(docs):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
