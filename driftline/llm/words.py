"""Words and their 64-bit hashes, a batch of documents at a time."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

#: Entries after which a worker's memo of word hashes starts anew.
MEMO = 120_000

U = np.uint64


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_MEMO = _Memo()


def blobs(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def spaced(text: bytes, lower: bool) -> list[bytes]:
    """Words between runs of the ASCII white space 0x20, 0x09 to 0x0D; lower changes A-Z only."""
    return (text.lower() if lower else text).split()


def hashes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every document in one array, and the n + 1 offsets of the documents in it."""
    claim("words")
    offsets = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offsets[1:])
    flat = np.fromiter(map(_MEMO.__getitem__, chain.from_iterable(words)), U, int(offsets[-1]))
    return flat, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public domain constants of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def windows(flat: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, for each place with n words left; doubling, so in log2(n) steps."""
    if len(flat) < n:
        return np.empty(0, U)
    done, length = mix(flat * U(0x9E3779B97F4A7C15) + U(n)), 1
    while length < n:
        step = min(length, n - length)  # the second part overlaps the first when n is no power of two
        done = mix(done[: len(done) - step] * U(0x9E3779B97F4A7C15) + (done[step:] ^ U(0xD6E8FEB86659FD93)))
        length += step
    return done


_held: dict = {"words": lambda: _MEMO.clear()}
_last = ["words"]


def claim(owner: str, forget=None) -> None:
    """What a worker remembers between tasks belongs to one operator at a time: at the start of another's task, the others forget."""
    if forget is not None:
        _held[owner] = forget
    if _last[0] != owner:
        for name, drop in _held.items():
            if name != owner:
                drop()
        _last[0] = owner


def batches(it, most: int = 3 << 20):
    """Record batches cut so that each holds about ``most`` bytes, or one row."""
    for b in it:
        start, size = 0, b.nbytes
        rows = max(1, int(b.num_rows * most / max(size, 1)))
        while start < b.num_rows:
            yield b.slice(start, rows)
            start += rows
