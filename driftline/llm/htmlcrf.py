"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM, decoded by Viterbi.

A leaf block is the text between two boundaries of block-level elements (also br and hr). Its inputs are the tags
and the class and id words of its ancestors, and figures of its text: number of words, share of words inside links,
final mark, capitals. Two states: main text or not. Weights are fitted by conditional likelihood on labelled
pages, written by ``labelled_pages`` from a rule with a fixed seed: articles in several layouts with menus, headers, footers, sidebars,
notices, adverts, forms and reader comments in and around them.

Scripts, styles, drawings (svg), comments, and what is in head never become blocks; formulas (math) are text of their block. Character references are decoded, white space inside
a block becomes one space, blocks of main text are joined in page order by one space. Null or empty html, and a page
without main text, give an empty text. Malformed markup is taken as far as it goes: an end tag closes up to its nearest open start, an unclosed
tag ends where the page ends, "<" before anything but a tag is text. Each row is a page of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import words

_TAG = re.compile(r"""<(?:(!--)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)|[!?][^>]*+>)""")
_ATTR = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HINT = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select option".split())
MATH = frozenset("math annotation annotation-xml maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
#: An open element of the key's kind is closed by a new one, unless an element of the list stands between.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("table ul ol dl div section article aside nav main body form blockquote header footer td th".split())
#: Class, id and role words that count as one hint.
HINTS = {
    "ad": "ad ads advert advertisement advertising promo promoted sponsor sponsored banner",
    "note": "notice cookie cookies consent alert popup modal newsletter subscribe signup paywall",
    "comment": "comment comments reply replies disqus discussion respond",
    "side": "sidebar side widget related recommended aside rail more share social tags",
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs toc pagination topbar",
    "head": "header masthead branding logo search",
    "foot": "footer foot copyright legal colophon bottom",
    "body": "content article post entry story main text body prose",
}
_HINT_OF = {w: k for k, v in HINTS.items() for w in v.split()}
TAGS = frozenset("nav header footer aside form article main section ul ol li table td h1 h2 h3 h4 p div blockquote pre figure figcaption button a address dialog menu".split())


@lru_cache(4096)
def _hints(attributes: str) -> tuple[str, ...]:
    found = (w for m in _ATTR.finditer(attributes) for w in _HINT.findall((m[1] or m[2] or m[3] or "").lower()))
    return tuple(sorted({"." + _HINT_OF[w] for w in found if w in _HINT_OF}))


def blocks(page: str) -> list[tuple[str, tuple[str, ...], int]]:
    """(text, marks of its ancestors, characters inside links) of each leaf block with text, in page order.

    In time linear in the page, however deep: each open element carries the marks of its path, and the places of the
    open elements of each tag are known.
    """
    out: list[tuple[str, tuple[str, ...], int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # tag, and marks of the path down to it
    opened: dict[str, list[int]] = {}  # places in the stack, ascending, of each tag
    parts: list[str] = []
    linked, links, at, lower = 0, 0, 0, None
    path: tuple[str, ...] = ()  # marks of the block at hand: inline elements do not change them
    closed = page.rfind(">") + 1  # no tag ends behind this

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split()) if len(parts) > 1 or "&" in parts[0] else " ".join(parts[0].split())
            if text:
                out.append((text, path, linked))
            parts.clear()
        linked = 0

    def last(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=-1)

    def push(tag: str, hints: tuple[str, ...]) -> None:
        above = stack[-1][1] if stack else ()
        own = (*hints, tag) if tag in TAGS else hints
        marks = above if all(m in above for m in own) else tuple(sorted({*above, *own}))
        opened.setdefault(tag, []).append(len(stack))
        stack.append((tag, marks))

    def cut(place: int) -> None:
        while len(stack) > place:
            opened[stack.pop()[0]].pop()

    while True:
        m = _TAG.search(page, at, closed)
        if not m:
            break
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) if links else 0
        at = m.end()
        if m[1]:
            end = page.find("-->", at)
            at = len(page) if end < 0 else end + 3
            continue
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag == "a":
                links = max(0, links - 1)
            if tag not in INLINE:
                flush()
            if opened.get(tag):
                cut(opened[tag][-1])
                path = stack[-1][1] if stack else ()
            continue
        if tag == "svg" and m[4].endswith("/>"):
            continue  # only foreign elements close themselves; a script or style does not
        if tag in RAW or tag == "head":
            if tag != "head":
                lower = page.lower() if lower is None else lower
                # a page whose lower case has another length is searched as it is
                end = (lower if len(lower) == len(page) else page).find("</" + tag, at)
                at = len(page) if end < 0 else page.find(">", end) + 1 or len(page)
            else:
                flush()
                push(tag, ())
            continue
        if tag not in INLINE:
            flush()
            if tag == "body":
                cut(0)
            if tag in CLOSES and (place := last(CLOSES[tag])) >= 0 and place >= last(SCOPE):
                cut(place)
        if tag in VOID or m[4].endswith("/>"):
            continue
        if tag == "a":
            links += 1
        push(tag, _hints(m[4]) if len(m[4]) > 3 else ())
        if tag not in INLINE:
            path = stack[-1][1]
    comment = page.find("<!--", at)
    if at < (len(page) if comment < 0 else comment):
        parts.append(page[at : None if comment < 0 else comment])
        linked += (comment - at) if links and comment >= 0 else 0
    flush()
    return out


def figures(text: str, linked: int) -> list[str]:
    """Marks of a block's own text."""
    n = text.count(" ") + 1
    share = linked / max(len(text), 1)
    return [
        "bias",
        "n<3" if n < 3 else "n<8" if n < 8 else "n<20" if n < 20 else "n<60" if n < 60 else "n+",
        "l0" if linked == 0 else "l<.4" if share < 0.4 else "l+",
        "dot" if text[-1] in ".!?:;\"')»”" else "nodot",
        "(c)" if "\xa9" in text[:80] else "no(c)",
    ]


def inputs(page: str) -> tuple[list[str], list[list[str]]]:
    found = blocks(page)
    marks = [[*("^" + a for a in path), *figures(text, linked)] for text, path, linked in found]
    return [t for t, _, _ in found], marks


def labelled_pages(count: int, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Pages and the label of each of their blocks (1: main text), written by rule."""
    rng, layout = np.random.default_rng(seed), np.random.default_rng(seed + 1)
    parts = ["ba", "lo", "mi", "tra", "ne", "sur", "qui", "den", "ol", "ve", "ti", "ga", "con", "re", "per"]

    def text(lo: int, hi: int, stop: bool = True) -> str:
        n = int(rng.integers(lo, hi + 1))
        own = ["".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(n)]
        own[0] = own[0].capitalize()
        kind = rng.random()
        if kind < 0.08:
            own = [w.upper() + "!!" for w in own]
        elif kind < 0.16:
            own = [w + "***" for w in own]
        return " ".join(own) + ("." if stop and kind > 0.16 else "")

    def either(*options: str) -> str:
        return options[int(rng.integers(len(options)))]

    def page() -> tuple[str, list[int]]:
        out: list[str] = []
        labels: list[int] = []

        def add(markup: str, label: int, n: int = 1) -> None:
            out.append(markup)
            labels.extend([label] * n)

        def links(lo: int, hi: int) -> None:
            for _ in range(int(rng.integers(lo, hi))):
                add(f'<li><a href="/x">{text(1, 3, False)}</a></li>', 0)

        def other(kinds: list[str]) -> None:
            kind = either(*kinds)
            if kind == "nav":
                tag = either("nav", 'div class="menu"', 'nav class="breadcrumb"')
                out.append(f"<{tag}><ul>")
                links(2, 8)
                out.append(f"</ul></{tag.split()[0]}>")
            elif kind == "ad":
                tag = either('div class="ad"', 'div class="ads banner"', 'aside class="promo"', 'div id="sponsor"')
                out.append(f"<{tag}>")
                add(either(text(2, 30), f"<p>{text(3, 20)}</p>", f'<a href="/y">{text(2, 6)}</a>'), 0)
                out.append(f"</{tag.split()[0]}>")
            elif kind == "notice":
                out.append(either('<div class="cookie-notice">', '<div role="alert" class="notice">', '<div class="newsletter">'))
                add(f"<p>{text(4, 25)}</p>", 0)
                out.append("</div>")
            elif kind == "form":
                out.append('<form action="/s">')
                add(f"<label>{text(1, 6, False)}</label><input name=q>", 0)
                add(f"<button>{text(1, 2, False)}</button>", 0)
                out.append("</form>")
            elif kind == "aside":
                tag = either("aside", 'div class="sidebar"', 'div class="related"')
                out.append(f"<{tag}>")
                add(f"<h3>{text(1, 4, False)}</h3>", 0)
                for _ in range(int(rng.integers(1, 4))):
                    add(f"<p>{text(3, 40)}</p>", 0)
                out.append(f"</{tag.split()[0]}>")
            elif kind == "comments":
                tag = either('section class="comments"', 'div id="comments"')
                out.append(f"<{tag}>")
                add(f"<h2>{text(1, 3, False)}</h2>", 0)
                for _ in range(int(rng.integers(1, 5))):
                    out.append('<div class="comment">')
                    add(f"<p>{text(3, 60)}</p>", 0)
                    out.append("</div>")
                out.append(f"</{tag.split()[0]}>")
            elif kind == "header":
                out.append("<header>")
                add(f"<div class=logo>{text(1, 3, False)}</div>", 0)
                if rng.random() < 0.5:
                    add(f"<p>{text(2, 9)}</p>", 0)
                out.append("</header>")
            else:
                tag = either("footer", 'div class="footer"')
                out.append(f"<{tag}>")
                add(either(f"&copy; {text(1, 4)} &middot; {text(3, 12)}", f"<p>{text(3, 30)}</p>", f"&copy; {text(2, 20)}"), 0)
                out.append(f"</{tag.split()[0]}>")

        out.append("<!DOCTYPE html><html><head><title>" + text(2, 6) + "</title></head><body>")
        for _ in range(int(rng.integers(1, 4))):
            other(["nav", "ad", "notice", "form", "header", "aside", "nav", "ad"])
        shell = either("article", "article", "article", 'div class="content"', "main", 'div class="post entry"', 'div id="main"')
        # an article may stand in a cell of a table that lays out the page, with other cells beside it
        cell = layout.random() < 0.15
        if layout.random() < 0.12:
            shell = "div"
        if cell:
            out.append("<table><tr>")
            if layout.random() < 0.5:
                out.append("<td>")
                links(2, 6)
                out.append("</td>")
            out.append("<td>")
        if not cell or layout.random() < 0.4:
            out.append(f"<{shell}>")
        else:
            shell = ""
        if rng.random() < 0.9:
            add(f"<h1>{text(1, 9, rng.random() < 0.3)}</h1>", 1)
        for k in range(int(rng.integers(1, 9))):
            roll = rng.random()
            if roll < 0.62:
                add(f"<p>{text(1, 90)}" + either("</p>", "</p>", ""), 1)
            elif roll < 0.7:
                add(f"<p><b>{text(1, 50)}<br>", 1)
                add(f"<p>{text(1, 40)}</p>", 1)
            elif roll < 0.76:
                add(f"<h2>{text(1, 6, False)}</h2>", 1)
            elif roll < 0.84:
                out.append("<ul>")
                for _ in range(int(rng.integers(1, 5))):
                    add(f"<li>{text(1, 14)}</li>", 1)
                out.append("</ul>")
            elif roll < 0.88:
                add(f"<blockquote>{text(2, 40)}</blockquote>", 1)
            elif roll < 0.92:
                add(f"<pre>{text(1, 20)}</pre>", 1)
            elif k:
                other(["ad", "notice", "aside", "form", "ad"])
        if rng.random() < 0.25:
            other(["comments"])
        if shell:
            out.append(f"</{shell.split()[0]}>")
        if cell:
            out.append("</td></tr></table>")
        for _ in range(int(rng.integers(0, 3))):
            other(["comments", "aside", "ad", "nav", "form", "notice"])
        if rng.random() < 0.9:
            other(["footer"])
        return "".join(out) + either("</body></html>", ""), labels

    return [page() for _ in range(count)]


def _sums(unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Log messages forward and backward of a chain, and its log partition."""
    n = len(unary)
    fore, back = np.zeros_like(unary), np.zeros_like(unary)
    fore[0] = unary[0]
    for i in range(1, n):
        fore[i] = unary[i] + np.logaddexp.reduce(fore[i - 1][:, None] + trans, axis=0)
    for i in range(n - 2, -1, -1):
        back[i] = np.logaddexp.reduce(trans + (unary[i + 1] + back[i + 1])[None, :], axis=1)
    return fore, back, float(np.logaddexp.reduce(fore[-1]))


def fit(pages: list[tuple[str, list[int]]], steps: int = 60) -> dict:
    """Weights of each mark for the two states, and of each step between states, by conditional likelihood."""
    data = [(m, np.array(y)) for page, y in pages for _, m in [inputs(page)] if len(m) == len(y) and len(y)]
    names = sorted({a for m, _ in data for own in m for a in own})
    place = {a: k for k, a in enumerate(names)}
    coded = []
    for m, y in data:
        x = np.zeros((len(m), len(names)))
        for i, own in enumerate(m):
            x[i, [place[a] for a in own]] = 1
        coded.append((x, y))
    w, t = np.zeros((len(names), 2)), np.zeros((2, 2))
    gw2, gt2 = np.full_like(w, 1e-6), np.full_like(t, 1e-6)
    for _ in range(steps):
        gw, gt = -0.02 * w, -0.02 * t
        for x, y in coded:
            u = x @ w
            fore, back, z = _sums(u, t)
            gw += x.T @ (np.eye(2)[y] - np.exp(fore + back - z))
            for i in range(1, len(y)):
                gt[y[i - 1], y[i]] += 1
                gt -= np.exp(fore[i - 1][:, None] + t + (u[i] + back[i])[None, :] - z)
        gw2 += gw**2
        gt2 += gt**2
        w += 0.5 * gw / np.sqrt(gw2)
        t += 0.5 * gt / np.sqrt(gt2)
    return {"w": {a: (float(w[k, 0]), float(w[k, 1])) for a, k in place.items()}, "t": t.tolist()}


def decode(model: dict, marks: list[list[str]]) -> list[int]:
    """Best states of a page's blocks, by Viterbi."""
    w, t = model["w"], model["t"]
    best, trail = (0.0, 0.0), []
    none = (0.0, 0.0)
    for i, own in enumerate(marks):
        a = b = 0.0
        for m in own:
            x = w.get(m, none)
            a += x[0]
            b += x[1]
        if i == 0:
            best = (a, b)
            continue
        s0, s1 = best[0] + t[0][0], best[1] + t[1][0]
        r0, r1 = best[0] + t[0][1], best[1] + t[1][1]
        trail.append((0 if s0 >= s1 else 1, 0 if r0 >= r1 else 1))
        best = (a + max(s0, s1), b + max(r0, r1))
    state = 0 if best[0] >= best[1] else 1
    out = [state]
    for step in reversed(trail):
        state = step[state]
        out.append(state)
    return out[::-1] if marks else []


def main_text(model: dict, page: str | None) -> str:
    if not page:
        return ""
    texts, marks = inputs(page)
    return " ".join(t for t, s in zip(texts, decode(model, marks), strict=True) if s)


PAGES = 300
_model: dict = {}


def model() -> dict:
    if not _model:
        _model.update(fit(labelled_pages(PAGES)))
    return _model


def _extract(m):
    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([main_text(m, h) for h in b.column(1).to_pylist()], pa.string())], names=["row", "text"])

    return run


def extract(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the main text of each row's html."""
    rows = pages.select(F.struct(*keys).alias("row"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(model()), f"row {rows.schema['row'].dataType.simpleString()}, text string").select("row.*", "text")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url"])
    return out.withColumn("n_chars", F.length("text").cast("long"))
