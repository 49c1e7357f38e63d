"""Dense figures of a text that say how it is written, not what about."""

from __future__ import annotations

import numpy as np

from driftline.llm import words

NAMES = (
    "log_bytes", "log_words", "letters", "upper", "digits", "spaces", "stops", "marks", "symbols", "bangs", "pipes",
    "non_ascii", "word_length", "distinct", "most_common", "repeats", "same_lines", "line_words", "symbol_ends",
)

_CLASS = np.full(256, 7, np.uint8)  # 7: other symbols
for _chars, _k in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), ((32, 9, 10, 11, 12, 13), 3), (b".", 4), (b",;:'\"-()?", 5), (b"!", 8), (b"|", 9), (range(128, 256), 6)):
    _CLASS[list(_chars)] = _k
_ENDS = tuple(b"*$#%&!|")


def features(texts: list[bytes]) -> np.ndarray:
    """One row of NAMES for each UTF-8 text; a text without bytes or words has zeros where a share has no whole."""
    out = np.zeros((len(texts), len(NAMES)))
    split = [words.spaced(t, lower=False) for t in texts]
    flat, off = words.hashes(split)
    for i, (text, own) in enumerate(zip(texts, split, strict=True)):
        n = len(text)
        if not n:
            continue
        kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=10) / n
        row = out[i]
        row[0] = np.log1p(n)
        row[1] = np.log1p(len(own))
        row[2:12] = kinds[0] + kinds[1] + kinds[6], kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[7], kinds[8], kinds[9], kinds[6]
        if own:
            h = flat[off[i] : off[i + 1]]
            ordered = np.sort(h)
            edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
            lines = [x for x in text.split(b"\n") if x.strip()]
            row[12] = min(n / len(own), 100)
            row[13] = (len(edge) - 1) / len(own)
            row[14] = np.diff(edge).max() / len(own)
            row[15] = float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0
            row[16] = 1 - len(set(lines)) / len(lines)
            row[17] = np.log1p(len(own) / len(lines))
            row[18] = sum(w[-1] in _ENDS for w in own) / len(own)
    return out
