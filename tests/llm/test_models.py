"""Learned operators: held-out accuracy and defined results for odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import htmlcrf, quality, textstats, toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    """Clean prose, junk, and prose with insults, in numbers that both kinds of folds see."""
    rng = np.random.default_rng(3)
    plain = ["river", "stone", "walks", "under", "the", "bridge", "and", "sings", "softly", "again"]
    rows, labels = [], []
    for i in range(400):
        own = list(rng.choice(plain, 40))
        kind = i % 4
        if kind == 1:
            own = [w + "***" for w in own]
        if kind == 2:
            for k in (3, 17, 30):
                own[k] = str(rng.choice(["blarg", "snorf", "gritch"]))
        rows.append((i, " ".join(own) + "."))
        if i % 5:
            labels.append((i, int(kind != 1), int(kind == 2)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    return docs, spark.createDataFrame([*labels, (5000, 1, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def test_quality(labelled):
    docs, labels = labelled
    got = {r.doc_id: r.score for r in quality.scores(docs, labels).collect()}
    assert len(got) == 403 and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 80 and np.mean([(got[i] >= 0.5) == (i % 4 != 1) for i in held]) > 0.98


def test_interactions_are_learned():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x[:2000], y[:2000])
    assert {0, 1} in [{a, b} for a, b, _ in m["pairs"]]
    assert ((quality.score(m, x[2000:]) > 0.5) == y[2000:]).mean() > 0.9


def test_one_kind_of_label():
    x = np.ones((5, 3))
    assert (quality.score(quality.fit(x, np.ones(5)), x) > 0.5).all()
    assert (quality.score(quality.fit(x[:0], np.ones(0)), x) == 0.5).all()


def test_toxicity(spark, labelled):
    docs, labels = labelled
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    unseen = [i for i in range(400) if i % 5 == 0]
    assert np.mean([got[i].toxic == (i % 4 == 2) for i in unseen]) > 0.98
    assert not got[1000].toxic and not got[1001].toxic
    kept = toxicity.clean(docs.withColumn("toxic", F.lit("x")), labels)
    assert kept.columns == ["doc_id", "text", "toxic"]
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if not r.toxic}
    assert toxicity.clean(docs, labels.limit(0)).count() == docs.count()
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_chain_passes_probabilities_on():
    """The second category is the first one's label on rows without words: only the chain can tell."""
    rng = np.random.default_rng(5)
    held = [[0] if k % 2 else [] for k in range(400)]
    first = np.array([float(bool(h)) for h in held])
    m = toxicity.fit(held, rng.random((400, 2)) * 0.01, {"a": first, "b": first}, np.arange(400) % 5, 1)
    assert len(m["chain"][1][1]) == len(m["chain"][0][1]) + 1 and m["chain"][1][1][-1] > 0.1


def test_text_figures():
    x = textstats.features([b"", b"   ", b"A b", "é" .encode(), b"a a a a\na a"])
    assert x.shape == (5, len(textstats.NAMES)) and not x[0].any() and np.isfinite(x).all()


def test_blocks():
    page = '<html><head><title>t</title><style>p{}</style></head><body><div class="ad">x &amp; y</div><article><h1>A  b</h1><p>One <b>two</b>\n three<br>four<p>five &lt;six&gt; < 7</article><script>var a="</p>";</script><!-- <p>no</p> --><p>last'
    assert [(t, "article" in m) for t, m, _ in htmlcrf.blocks(page)] == [("x & y", False), ("A b", True), ("One two three", True), ("four", True), ("five <six> < 7", True), ("last", False)]
    assert [m for _, m, _ in htmlcrf.blocks(page)][0] == (".ad", "div")


def test_odd_pages():
    m = htmlcrf.model()
    for page in (None, "", "   ", "<", "<p", "</div></div>", "<script>", "<!-- x", "<a href='", "<p>" * 5000, "&#xZZ; &bogus;", "<\x00>"):
        assert isinstance(htmlcrf.main_text(m, page), str)


def test_drawings_and_formulas():
    texts = lambda page: [t for t, _, _ in htmlcrf.blocks(page)]
    assert texts('<p>one <svg viewBox="0 0 1 1"/> two</p><p>three</p>') == ["one two", "three"]
    assert texts("<p>one <svg><text>no</text></svg> two</p><p>three") == ["one two", "three"]
    assert texts("<p>one <math/> two</p><p>three</p>") == ["one two", "three"]
    assert texts("<p>where <math><mi>x</mi> <mo>=</mo> <mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds</p>") == ["where x = 12 holds"]
    text = "The first paragraph of this article has a good number of words and ends with a full stop."
    page = f'<html><body><article><h1>Title of it</h1><p>{text}</p><svg class="icon"/><p>{text} Then <math><mi>y</mi></math> follows.</p></article></body></html>'
    got = htmlcrf.main_text(htmlcrf.model(), page)
    assert got.count(text) == 2 and "Then y follows." in got


def test_labels_follow_blocks_and_held_out_pages():
    m, right, total = htmlcrf.model(), 0, 0
    for page, labels in htmlcrf.labelled_pages(150, seed=99):
        texts, marks = htmlcrf.inputs(page)
        assert len(texts) == len(labels)
        right += sum(a == b for a, b in zip(htmlcrf.decode(m, marks), labels, strict=True))
        total += len(labels)
    assert right / total > 0.97


def test_viterbi_is_the_best_path():
    import itertools

    rng = np.random.default_rng(4)
    marks = [[f"m{i}"] for i in range(6)]
    m = {"w": {f"m{i}": tuple(rng.normal(size=2)) for i in range(6)}, "t": rng.normal(size=(2, 2)).tolist()}
    value = lambda y: sum(m["w"][f"m{i}"][s] for i, s in enumerate(y)) + sum(m["t"][a][b] for a, b in zip(y, y[1:], strict=False))
    assert tuple(htmlcrf.decode(m, marks)) == max(itertools.product((0, 1), repeat=6), key=value)


def test_pages(spark, sf):
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in htmlcrf.extract(pages, ["page_id"]).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        body = re.sub(r"<[^>]*>", "", re.sub(r"<(/?p|br|/?h1)>", " ", body))
        assert got[r.page_id] == " ".join(html.unescape(body).split())
    odd = spark.createDataFrame([(1, None, "u"), (1, "", "u"), (2, "<article><p>Hello there, this is text.</p></article>", None)], "page_id long, html string, url string")
    assert sorted((r.page_id, r.text) for r in htmlcrf.extract(odd, ["page_id", "url"]).collect()) == [(1, ""), (1, ""), (2, "Hello there, this is text.")]


def test_deep_pages_take_linear_time():
    page = "<div>" * 100_000 + "<p>One two three four five six seven eight nine ten.</p>" + "</div>" * 100_000
    assert [t for t, _, _ in htmlcrf.blocks(page)] == ["One two three four five six seven eight nine ten."]
    assert htmlcrf.blocks('<p>a<a "' * 50_000) == htmlcrf.blocks('<p>a<a "' * 50_000)
    assert [t for t, _, _ in htmlcrf.blocks("<p>a</p>b <!-- c")] == ["a", "b"]


def test_articles_in_layout_tables_and_plain_boxes():
    body = "<h1>Title of this</h1><p>One two three four five six seven eight nine ten eleven.</p><p>And a second paragraph of the text that is long enough.</p>"
    want = "Title of this One two three four five six seven eight nine ten eleven. And a second paragraph of the text that is long enough."
    m = htmlcrf.model()
    assert htmlcrf.main_text(m, f"<table><tr><td><ul><li><a href=x>Home</a></li></ul></td><td>{body}</td></tr></table>") == want
    assert htmlcrf.main_text(m, f"<div><div>{body}</div></div>") == want


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert htmlcrf.extract(pages, ["page_id", "url"]).count() == 0
    some = spark.createDataFrame([(1, "u", None, "t"), (1, "u", "", "t"), (None, None, "<article><p>One two three four five six seven.</p></article>", None)], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text) for r in htmlcrf.extract(some, ["page_id", "url"]).collect())
    assert got == [(0, "One two three four five six seven."), (1, ""), (1, "")]


def test_repeated_ids_give_one_row_to_fit(spark, labelled):
    docs, labels = labelled
    many = docs.where("doc_id = 3").crossJoin(spark.range(500).select(F.col("id").alias("n"))).select("doc_id", F.concat("text", F.col("n").cast("string")).alias("text"))
    all_ = docs.unionByName(many)
    got = {r.doc_id: r.score for r in quality.scores(all_, labels).where("doc_id <> 3").collect()}
    assert sum((got[i] >= 0.5) == (i % 4 != 1) for i in range(400) if i != 3) > 390
    assert toxicity.toxicity(all_, labels).where("doc_id = 3").count() == 501
    assert quality.scores(docs.limit(0), labels).count() == 0
