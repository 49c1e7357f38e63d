"""Every query and every stage on tables of odd rows, with columns whose names the operators use themselves, and on empty ones."""

import pytest
from pyspark.sql import functions as F

from driftline.llm import fmindex, registry

CLASHING = "before: long, _part: long, toxic: boolean, junk: int, label: string, score: double, held: string, terms: string, figures: string, n: long, a: long, b: long, band: long, rep: long, component: long, component_id: long, kept: boolean, n_shingles: long, taken: long, target: double, u: long, spans: string, items: string, __spans: string, __items: string, start: long, n_tokens: long, ids_crc32: long, tie: long, hash: string, h: long, x: long, item_id: long, quality: int"
NAMES = [c.split(":")[0].strip() for c in CLASHING.split(",")]
KINDS = [c.split(":")[1].strip() for c in CLASHING.split(",")]


def folder(spark, path, docs, empty):
    some = lambda df: df.limit(0) if empty else df
    docs = docs.withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.when(F.col("doc_id") > 5, F.length("text").cast("long"))})
    for k, (name, kind) in enumerate(zip(NAMES, KINDS, strict=True)):
        docs = docs.withColumn(name, F.when(F.crc32(F.coalesce("text", F.lit(""))) % 2 == k % 2, F.lit("1" if kind != "boolean" else "true").cast(kind)))
    some(docs).write.parquet(f"{path}/documents.parquet")
    text = "a benchmark question of ten words or more is here"
    items = [(1, "one two"), (1, "ONE, two!"), (None, "naïve café"), (2, None), (3, ""), (4, text), (None, None)]
    some(spark.createDataFrame(items, "item_id long, text string")).write.parquet(f"{path}/benchmark.parquet")
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(1, 19)] + [(1, None, 1), (None, 1, 1), (2, 0, None), (999, 1, 1)]
    some(spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).write.parquet(f"{path}/labels.parquet")
    pages = [(1, "u", None), (1, "u", ""), (None, None, "<p>x</p>" * 3), (3, None, "<div>" + "word " * 50_000), (3, "u", "<div>" + "word " * 50_000)]
    some(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(1))).write.parquet(f"{path}/pages.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd_dir(spark, odd_docs, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("odd"), odd_docs, False)


@pytest.fixture(scope="module")
def empty_dir(spark, odd_docs, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), odd_docs, True)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, odd_dir, empty_dir, odd, name):
    got = registry.QUERIES[name](spark, odd_dir).collect()
    assert len(got) == (5 if name.startswith("op6") else len(odd))
    assert registry.QUERIES[name](spark, empty_dir).count() == 0


def test_stages(spark, odd_dir, empty_dir, odd, tmp_path):
    import corpus_pipeline

    for k, path in enumerate((odd_dir, empty_dir)):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            before, out = docs, f"{tmp_path}/{k}-{name}"
            stage(spark, docs, path).write.parquet(out)
            docs = spark.read.parquet(out)
            if name != "tokens":
                assert docs.columns == before.columns, name
            if name in ("toxicity", "near_dedup"):  # rows go or stay as they are
                assert docs.exceptAll(before).count() == 0, name
        assert (docs.count() == 0) == (k == 1)


@pytest.mark.parametrize("block", [fmindex.BLOCK, 1])
def test_cut_keeps_the_other_columns(spark, odd_dir, odd, monkeypatch, block):
    monkeypatch.setattr(fmindex, "BLOCK", block)
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    got = fmindex.stage(spark, docs, odd_dir)
    gone = {"one two", "ONE two"}  # nothing is left of these
    assert sorted(str((r.doc_id, r.ord, r["__spans"], r["__items"], r.spans)) for r in got.collect()) == sorted(str((r.doc_id, r.ord, r["__spans"], r["__items"], r.spans)) for r in docs.collect() if r.text not in gone)
