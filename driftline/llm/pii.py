"""Personal data in texts: four patterns, and a skip-chain conditional random field that adds what context shows.

Patterns, leftmost and non-overlapping per kind; a match that fails its check is dropped without a retry:
email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+; ip, four dotted numbers of at most 255; card, 12 to 19 digits with
single spaces or hyphens between, passing Luhn; phone, a plus sign and 9 to 15 digits. Null texts have none. Places are code points, end exclusive.

The field. Tokens are runs without white space, stripped of outer punctuation. Tokens with a digit or an at sign are variables over the states of
``STATES``; all others are held at "none", so that the chain factors over stretches of neighbouring variables and a
text without digits costs nothing. Inputs: the token's shape, its digits, base matches over it, and cue words shortly before it.
Skip edges join each variable of seven or more digits to the next one in the document that has the same digits (or the same last
seven), and any other of four or more characters, but a bare number, to the next one of the same letters, however far away; a number
of 7 to 19 digits written in neighbouring tokens is joined likewise, part by part. They carry a learned potential for equal states. Marginals come from loopy message passing, which
is exact forward-backward where no token recurs. Weights are fitted by the likelihood's gradient, with marginals from the same message
passing, on texts that ``examples`` writes from a rule with a fixed seed. A stretch of variables of one kind with a marginal of at
least ``SURE`` each, that overlaps no base span, becomes a span of that kind; base spans always stay.

Each row is a document of its own, repeated and null ids included. Empty tables give empty results; other columns are
ignored. Memory is bounded by a text and its tokens.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import words

KINDS = ("email", "ip", "card", "phone")
#: "other" stands for machine tokens, dates, amounts, versions and the like.
STATES = ("none", *KINDS, "other")
SURE, PASSES, DAMP = 0.6, 8, 0.3

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_KEY = re.compile(r"[0-9@]")
#: A token that can be a part of a number of at most MOST digits.
_PART, MOST = re.compile(r"[+(]*[0-9][0-9()-]*"), 19


def emails(text: str) -> list[tuple[int, int]]:
    """In time linear in the text: a match is a run of local characters, from the end of the last match on, before an at sign."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at)  # what stands before this sign cannot begin a later match
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, sorted."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_TOKEN = re.compile(r"\S+")
_TRIM = ".,;:!?\"'<>[]{}"
CUES = {
    "phone": "phone tel telephone call fax mobile cell telefon handy portable movil telefono",
    "email": "email e-mail mail write contact courriel correo",
    "ip": "ip host server address addr client adresse",
    "card": "card visa mastercard credit debit payment karte carte tarjeta",
    "other": "token password key secret version license order invoice page year chapter section no nr id",
}
_CUE = {w: k for k, v in CUES.items() for w in v.split()}


def _shape(token: str, digits: int) -> str:
    if "@" in token:
        return "at." if "." in token.rpartition("@")[2] else "at"
    if token.startswith("+"):
        return "plus"
    if digits == len(token):
        return "d1-2" if digits < 3 else "d3-4" if digits < 5 else "d5-8" if digits < 9 else "d9-11" if digits < 12 else "d12-19" if digits < 20 else "d20"
    dots = token.count(".")
    if dots == 3 and digits + 3 == len(token):
        return "quad"
    if digits + dots == len(token):
        return "decimal"
    if any(c.isalpha() for c in token):
        return "mixed"
    if digits >= 4 and all(c in "0123456789()-./" for c in token):
        return "parted"
    return "marks"


class Graph:
    """Variables of one document: token spans, inputs, and chain and skip edges."""

    def __init__(self, text: str, found: list[tuple[int, int, int]]):
        self.spans, self.marks, self.chain, self.skip = [], [], [], []
        self._last: dict[str, list[int]] = {}
        self._linked: set[tuple[int, int]] = set()
        previous, cues, parts, whole = None, [], [], False
        at = 0
        # only the surroundings of digits and at signs are cut into tokens
        place = 0
        for hit in _KEY.finditer(text):
            if hit.start() < at:
                continue
            start = hit.start()
            while start > at and not text[start - 1].isspace():
                start -= 1
            end = _TOKEN.match(text, start).end()
            gap = text[at:start]
            near = gap[-60:].split()
            place += 1 if len(near) > 3 or len(gap) > 60 else len(near)
            cues = [_CUE[w] for w in (x.strip(_TRIM).lower() for x in near[-3:]) if w in _CUE] or (cues if len(near) <= 1 and previous is not None else [])
            s, e = start, end
            while s < e and text[s] in _TRIM:
                s += 1
            while e > s and text[e - 1] in _TRIM:
                e -= 1
            if s == e:
                s, e = start, end
            token = text[s:e]
            digits = "".join(_DIGIT.findall(token))
            k = len(self.spans)
            own = ["bias", "s:" + _shape(token, len(digits)), *("c:" + c for c in cues), f"n:{min(len(digits), 20) // 3}"]
            own += ["b:" + KINDS[kind] for a, kind, b in found if a < e and s < b]
            if len(own) == 3 + len(cues):
                own.append("b:no")
            self.spans.append((s, e))
            self.marks.append(own)
            if previous is not None and not near:
                self.chain.append((k - 1, k))
            for name in (digits, "~" + digits[-7:]) if len(digits) >= 7 else (token.lower(),) if len(token) >= 4 and not token.isdigit() else ():
                self._link(name, [k])
            if not _PART.fullmatch(token):
                parts = []
            else:
                # marks between two tokens end a number that is written in parts
                parts = [*(parts if previous is not None and not near and whole and s == start else []), (k, digits)][-MOST:]
                joined = digits
                for i in range(len(parts) - 2, -1, -1):
                    joined = parts[i][1] + joined
                    if len(joined) > MOST:
                        break
                    if len(joined) >= 7:
                        shortest = len(joined) - len(parts[i][1]) < 7
                        for name in (joined, "~" + joined[-7:]) if shortest else (joined,):
                            self._link(name, [v for v, _ in parts[i:]])
            whole = e == end
            previous, at = k, end

    def _link(self, name: str, own: list[int]) -> None:
        """Skip edges from the last mention of that name to this one, part by part; the last part stands for those that one of them lacks."""
        old = self._last.get(name)
        if old and old[-1] < own[0]:
            for i in range(max(len(old), len(own))):
                pair = old[min(i, len(old) - 1)], own[min(i, len(own) - 1)]
                if pair not in self._linked:
                    self._linked.add(pair)
                    self.skip.append(pair)
        self._last[name] = own


def marginals(unary: np.ndarray, chain: list, skip: list, trans: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Beliefs of the variables, and of the pairs of all edges (chain, then skip), by message passing in both directions.

    A pass goes forward and backward through the edges in order, so that on a chain one pass is exact; with skip edges
    passes go on, damped, until messages stand still or PASSES are done.
    """
    forms = [(p, np.exp(p), np.exp(p.T)) for p in (trans, same)]
    edges = [(i, j, *forms[0]) for i, j in chain] + [(i, j, *forms[1]) for i, j in skip]
    order = sorted(range(len(edges)), key=lambda k: (edges[k][1], edges[k][0]))
    right, left = np.zeros((len(edges), unary.shape[1])), np.zeros((len(edges), unary.shape[1]))
    belief = unary.copy()
    for _ in range(PASSES if skip else 1):
        moved = 0.0
        for k in order:
            i, j, _, to, _ = edges[k]
            m = belief[i] - left[k]
            m = np.log(np.exp(m - m.max()) @ to + 1e-300)
            m -= m.max()
            m = m if not skip else (1 - DAMP) * m + DAMP * right[k]
            moved = max(moved, float(np.abs(m - right[k]).max()))
            belief[j] += m - right[k]
            right[k] = m
        for k in reversed(order):
            i, j, _, _, back = edges[k]
            m = belief[j] - right[k]
            m = np.log(np.exp(m - m.max()) @ back + 1e-300)
            m -= m.max()
            m = m if not skip else (1 - DAMP) * m + DAMP * left[k]
            moved = max(moved, float(np.abs(m - left[k]).max()))
            belief[i] += m - left[k]
            left[k] = m
        if moved < 1e-3:
            break
    pairs = []
    for k, (i, j, pot, _, _) in enumerate(edges):
        b = (belief[i] - left[k])[:, None] + pot + (belief[j] - right[k])[None, :]
        b = np.exp(b - b.max())
        pairs.append(b / b.sum())
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True), pairs


def examples(count: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with the state of each labelled stretch: (start, state, end)."""
    rng = np.random.default_rng(seed)
    syllables = ["ba", "lo", "mi", "tra", "ne", "sur", "qui", "den", "ol", "ve", "ti", "ga", "con", "re", "per"]

    def d(n: int) -> str:
        return "".join(str(x) for x in rng.integers(0, 10, n))

    def word() -> str:
        return "".join(rng.choice(syllables, int(rng.integers(1, 4))))

    def card() -> str:
        body = "4" + d(14)
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))

    def one() -> tuple[str, int, str | None]:
        """A value, its state, and a cue or none."""
        kind = int(rng.integers(0, 13))
        a, b, c = d(3), d(3), d(4)
        if kind == 0:
            form = [f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"+49 {a} {b}{c}", f"+1-{a}-{b}-{c}"][int(rng.integers(4))]
            return form, 4, "phone" if rng.random() < 0.4 else None
        if kind < 4:  # no pattern finds these: the cue at one mention has to tell
            form = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"0{a} {b}{c}", f"{a}.{b}.{c}", f"{a}{b}{c}", f"0{a}/{b}{c}"][int(rng.integers(6))]
            return form, 4, "phone"
        if kind == 4:
            form = ".".join(str(x) for x in rng.integers(1, 255, 4))
            return form, 2, "ip" if rng.random() < 0.4 else None
        if kind == 5:
            number = card()
            return (number if rng.random() < 0.6 else " ".join(number[k : k + 4] for k in range(0, 16, 4))), 3, "card" if rng.random() < 0.4 else None
        if kind == 6:
            form = f"{word()}.{word()}{d(2)}@{word()}.com"
            return form, 1, "email" if rng.random() < 0.4 else None
        if kind == 7:
            return f"{word()}.{word()}{d(2) if rng.random() < 0.5 else ''}@{word()}", 1, "email"
        form = [f"{word()}@{word()}", f"{a}.{b}.{c}", f"0{a}/{b}{c}", f"0{a} {b}{c}", d(int(rng.integers(1, 5))), f"{d(1)}.{d(1)}", f"{d(1)}.{d(1)}.{d(2)}", f"{d(2)}:{d(2)}", f"{d(2)}/{d(2)}/20{d(2)}", f"${d(2)},{d(3)}", "AKIA" + d(6) + word().upper(), f"password={d(4)}{word()}{d(4)}", f'"{d(12)}a{d(9)}"', d(int(rng.integers(5, 17))), f"{d(3)}-{d(3)}-{d(4)}"][int(rng.integers(0, 15))]
        return form, 5, "other" if rng.random() < 0.4 else None

    out = []
    for _ in range(count):
        parts, spans, at = [], [], 0

        def put(text: str, state: int = 0) -> None:
            nonlocal at
            if parts:
                at += 1
            if state:
                spans.append((at, state, at + len(text)))
            parts.append(text)
            at += len(text)

        values = [one() for _ in range(int(rng.integers(1, 4)))]
        for value, state, cue in [*values, *(v for _ in range(2) for v in values if rng.random() < 0.4)]:
            for _ in range(int(rng.integers(2, 9))):
                put(word())
            # the cue stands before the first mention alone; what links the others to it is the repeated token
            if cue and (value, state, cue) in values:
                put(str(rng.choice(CUES[cue].split())) + (":" if rng.random() < 0.3 else ""))
                values.remove((value, state, cue))
            put(value, state)
        put(word())
        out.append((" ".join(parts), spans))
    return out


def fit(data: list[tuple[str, list[tuple[int, int, int]]]], steps: int = 40) -> dict:
    graphs = []
    for text, spans in data:
        g = Graph(text, base(text))
        y = np.array([next((k for s, k, e in spans if s < b and a < e), 5) for a, b in g.spans], int)
        if len(y):
            graphs.append((g, y))
    names = sorted({m for g, _ in graphs for own in g.marks for m in own})
    place = {m: k for k, m in enumerate(names)}
    n = len(STATES)
    w, t, e = np.zeros((len(names), n)), np.zeros((n, n)), np.zeros(n)
    sums = [np.full_like(w, 1e-6), np.full_like(t, 1e-6), np.full_like(e, 1e-6)]
    eye = np.eye(n)
    coded = []
    for g, y in graphs:
        x = np.zeros((len(y), len(names)))
        for i, own in enumerate(g.marks):
            x[i, [place[m] for m in own]] = 1
        coded.append((x, y, g))
    for _ in range(steps):
        gw, gt, ge = -0.05 * w, -0.05 * t, -0.01 * e
        for x, y, g in coded:
            p, pairs = marginals(x @ w, g.chain, g.skip, t, e * eye)
            gw += x.T @ (eye[y] - p)
            for (i, j), b in zip(g.chain, pairs, strict=False):
                gt -= b
                gt[y[i], y[j]] += 1
            for (i, j), b in zip(g.skip, pairs[len(g.chain) :], strict=True):
                ge -= b.diagonal()
                ge[y[i]] += float(y[i] == y[j])
        for k, (v, gv) in enumerate(((w, gw), (t, gt), (e, ge))):
            sums[k] += gv**2
            v += 0.5 * gv / np.sqrt(sums[k])
    return {"place": place, "w": w, "t": t, "skip": np.diag(e)}


EXAMPLES = 150
_model: dict = {}


def model() -> dict:
    if not _model:
        _model.update(fit(examples(EXAMPLES)))
    return _model


def added(m: dict, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base spans of a text."""
    if not _KEY.search(text):
        return []
    g = Graph(text, found)
    w, place = m["w"], m["place"]
    unary = np.array([w[[place[a] for a in own if a in place]].sum(0) for own in g.marks])
    p = marginals(unary, g.chain, g.skip, m["t"], m["skip"])[0]
    state = np.where(p.max(1) >= SURE, p.argmax(1), 0)
    joined = {j for _, j in g.chain}
    out: list[tuple[int, int, int]] = []
    for k, (s, e) in enumerate(g.spans):
        kind = int(state[k]) - 1
        if not 0 <= kind < len(KINDS):
            continue
        if out and k in joined and state[k - 1] == state[k] and out[-1][2] == g.spans[k - 1][1]:
            out[-1] = (out[-1][0], kind, e)
        else:
            out.append((s, kind, e))
    return [x for x in out if not any(a < x[2] and x[0] < b for a, _, b in found)]


def _find(m):
    m = dict(m)

    def run(it):
        for b in (s for x in it for s in words.batches([x])):
            cols: list[list] = [[], [], [], [], [], []]
            for text in b.column(1).to_pylist():
                text = text or ""
                found = base(text)
                for k in range(4):
                    cols[k].append(sum(kind == k for _, kind, _ in found))
                cols[4].append(hashlib.sha256(render(found).encode()).hexdigest())
                cols[5].append(render(sorted(found + added(m, text, found))))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())], names=["row", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return run


def personal_data(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, number of base spans by kind, base_sha256 and spans of each row's text."""
    rows = docs.select(F.struct(*keys).alias("row"), F.col("text").cast("string").alias("text"))
    kind = f"row {rows.schema['row'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string"
    return rows.mapInArrow(_find(model()), kind).select("row.*", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
