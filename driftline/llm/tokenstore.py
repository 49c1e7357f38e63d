"""Token ids in a content-addressed store, written once a chunk and read back by recipe.

Each text is encoded whole (null: empty) and ``END`` is appended. The id stream of a document is cut where a rolling
polynomial hash of the last ``ROLL`` ids has zeros in its low bits, so that equal passages give equal chunks wherever
they stand. A chunk is named by the 128-bit BLAKE2b of its ids; a unique chunk is stored once.

Files, all Parquet, under one folder:
  store/kind=0   part, hash, blob (zstd of little-endian ids, 2 bytes an id for vocabularies up to 65,536, else 4), n
  store/kind=1   one recipe a document: doc_id, tie, n, hashes, ends (of the chunks, in ids)
  store/kind=2   one manifest a part: part, n (chunks) and hash (root of the Merkle tree over its sorted chunk names)
  recipes        the recipes in ascending doc_id (nulls last, ties by text hash), with rank and before (ids before)

Rows with equal or null doc_id are documents of their own. An empty table gives empty files and an empty result; other
columns are ignored. Every text is encoded whole, in effect: where the tokenizer's own description is that of byte-level BPE with
its usual pattern, a text whose spaces and line ends all stand alone is cut before them, where a pre-token always begins, and the ids of
its pieces are those that a worker remembers or the library gives; any other text, and any other tokenizer, is encoded in one go.

Plan. One scan encodes; a task sends each of its distinct chunks once, so a chunk that the whole corpus shares costs one row a
task. One shuffle by chunk name (recipes ride along) brings equal chunks together, and a sorted pass drops repeats and
computes the manifests. Reading back takes each stored chunk once: its name and length are verified and its CRC taken, and the CRC of a document is the
exclusive or of its chunks' CRCs, each advanced by the number of bytes behind it; so no ids are shuffled again.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import store, words

END = 2
ROLL, LOW_BITS, LEAST, MOST = 16, 9, 128, 4096
#: Pieces whose ids a worker remembers, and bytes of text that it encodes at a time.
MEMO, BATCH = 800_000, 6 << 20

_P = np.array([0x9E3779B97F4A7C15], np.uint64)
_ready: dict[str, tuple] = {}
#: White space, and more: what is wrongly taken for it only costs time.
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}\x{180e}]"
_ODD = rf"^$|^\n(?:{_SPACE}|$)|^[ \t\r\x0b\x0c\x1c-\x1f\x{{85}}\p{{Z}}\x{{180e}}]|{_SPACE}$"


class Memo:
    """Ids of the pieces used most, in flat arrays; when it is full, the less used half goes."""

    def __init__(self):
        self.names, self.ids, self.used = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int64)

    def lookup(self, names: pa.Array, counts: np.ndarray, fresh) -> pa.Array:
        """Ids of each of the distinct names, which occur counts times; ``fresh`` gives those that are not known."""
        place = pc.index_in(names, value_set=self.names)
        new = place.is_null().to_numpy(zero_copy_only=False)
        place = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        place[new] = len(self.names) + np.arange(int(new.sum()))
        added = names.filter(pa.array(new))
        ids = pa.concat_arrays([self.ids, fresh(added)])
        out = ids.take(pa.array(place))
        self.names, self.ids = pa.concat_arrays([self.names, added]), ids
        self.used = np.concatenate([self.used, np.zeros(len(added), np.int64)])
        self.used[place] += counts
        if len(self.used) > MEMO:
            stay = np.sort(np.argpartition(-self.used, MEMO // 2)[: MEMO // 2])
            self.names, self.ids, self.used = self.names.take(pa.array(stay)), self.ids.take(pa.array(stay)), self.used[stay] // 2
        return out


_memo = [Memo()]


def _forget() -> None:
    _ready.clear()
    _memo[0] = Memo()


def _newline(t) -> int | None:
    """The id of a line end, if the tokenizer's own description shows that a text may be cut before each single space or
    line end between other characters: byte-level pre-tokens by its usual pattern, and nothing that looks further."""
    import json

    said = json.loads(t.to_str())
    pre, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
    plain = not any(said.get(k) for k in ("normalizer", "post_processor", "truncation", "padding")) and not model.get("dropout")
    level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and model.get("type") == "BPE"
    marks = all(not (x.get("lstrip") or x.get("rstrip") or x.get("normalized") or x.get("single_word")) and not re.search(r"\s", x["content"]) for x in said.get("added_tokens") or ())
    ids = t.encode("\n", add_special_tokens=False).ids
    return ids[0] if plain and level and marks and len(ids) == 1 else None


def _tokenizer(path: str):
    """The tokenizer, the type of its ids, and its line end (None: texts must be encoded whole)."""
    if path not in _ready:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        if hasattr(t.model, "_resize_cache"):
            t.model._resize_cache(0)  # its own memo of 10,000 pieces would hold what ``Memo`` has already sorted out
        _forget()
        _ready[path] = t, np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4"), _newline(t)
    return _ready[path]


def _direct(texts: list[str], t, kind) -> list[bytes]:
    return [np.array(e.ids, kind).tobytes() for e in t.encode_batch_fast(texts, add_special_tokens=False)]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Array of byte strings that lie one after the other in data, from their ends in items."""
    off = np.zeros(len(ends) + 1, np.int64)
    off[1:] = ends * data.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])


def _listed(pieces: list[str], t, kind, newline: int, group: int = 2000) -> pa.Array:
    """Ids of pieces without white space but a line end that all or none of them begin with.

    Many are encoded as one text, one on a line, and told apart by the line ends' ids; a group that counts otherwise is
    encoded piece by piece.
    """
    lined = bool(pieces) and pieces[0][0] == "\n"
    out, groups = [], [pieces[i : i + group] for i in range(0, len(pieces), group)]
    for own, e in zip(groups, t.encode_batch_fast(["".join(g) if lined else " " + "\n ".join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(e.ids, kind)
        at = np.flatnonzero(ids == newline)
        if lined and len(at) == len(own) and at[0] == 0:
            out.append(_binary(ids, np.append(at[1:], len(ids))))
        elif not lined and len(at) == len(own) - 1:
            out.append(_binary(np.delete(ids, at), np.append(at, len(ids)) - np.arange(len(own))))
        else:
            out.append(pa.array(_direct(own if lined else [" " + p for p in own], t, kind), pa.large_binary()))
    return pa.concat_arrays(out) if out else pa.array([], pa.large_binary())


def _fresh(names: pa.Array, t, kind, newline: int) -> pa.Array:
    """Ids of each piece: as it is if it begins with a line end, else after a space."""
    lined = pc.starts_with(names, "\n").to_numpy(zero_copy_only=False)
    inner = pc.match_substring_regex(names, "(?s)." + _SPACE).to_numpy(zero_copy_only=False)
    kinds = [np.flatnonzero(~lined & ~inner), np.flatnonzero(lined & ~inner), np.flatnonzero(inner)]
    found = [_listed(names.take(pa.array(k)).to_pylist(), t, kind, newline) for k in kinds[:2]]
    rest = names.take(pa.array(kinds[2])).to_pylist()
    found.append(pa.array(_direct([p if p[0] == "\n" else " " + p for p in rest], t, kind), pa.large_binary()))
    return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(kinds))))


def _known(names: pa.Array, counts: np.ndarray, t, kind, newline: int) -> pa.Array:
    """Ids of each piece, by way of the memo; a word of letters and one final mark is looked up as its two parts."""
    marked = pc.match_substring_regex(names, r"^\n?\p{L}+[.,]$")
    stems = pc.if_else(marked, pc.utf8_slice_codeunits(names, 0, -1), names).dictionary_encode()
    place = stems.indices.to_numpy()
    ids = _memo[0].lookup(stems.dictionary, np.bincount(place, counts, len(stems.dictionary)).astype(np.int64), lambda x: _fresh(x, t, kind, newline)).take(stems.indices)
    dot, comma = (pa.scalar(x, pa.large_binary()) for x in _direct([".", ","], t, kind))
    none = pa.scalar(b"", pa.large_binary())
    return pc.binary_join_element_wise(ids, pc.if_else(marked, pc.if_else(pc.ends_with(names, "."), dot, comma), none), none)


def encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts with END after each, in one array, and the n + 1 offsets of the texts in it."""
    t, kind, newline = _tokenizer(path)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    end = np.array([END], kind).tobytes()
    if newline is None or not len(texts):
        each = pa.array([x + end for x in _direct(texts.to_pylist(), t, kind)], pa.large_binary())
        docs = np.arange(len(texts) + 1)
    else:
        # a line end is put before each text, so that its first piece is none of its own kind, and taken off again
        lines = pc.binary_join_element_wise(*(pa.scalar(x, pa.large_string()) if isinstance(x, str) else x for x in ("\n", pc.replace_substring(texts, "\n", " \n"), "")))
        split = pc.split_pattern(lines, " ")
        off = split.offsets.to_numpy()
        off = off - off[0]
        coded = split.flatten().dictionary_encode()
        del lines, split
        names, place = coded.dictionary, coded.indices.to_numpy()
        odd = pc.match_substring_regex(names, _ODD).to_numpy(zero_copy_only=False)
        good = np.flatnonzero(~odd)
        ids = _known(names.take(pa.array(good)), np.bincount(place, minlength=len(names))[good], t, kind, newline)
        to = np.full(len(names), len(good), np.int64)  # odd pieces: nothing
        to[good] = np.arange(len(good))
        whole = np.flatnonzero(np.add.reduceat(odd[place], off[:-1]) > 0)
        heads, head_of = np.unique(to[place[off[:-1]]], return_inverse=True)
        rest = [b"", end, *(x[kind.itemsize :] for x in pa.concat_arrays([ids, pa.array([b""], pa.large_binary())]).take(pa.array(heads)).to_pylist())]
        rest += _direct(texts.take(pa.array(whole)).to_pylist(), t, kind)
        seq = to[place]
        seq[off[:-1]] = len(good) + 2 + head_of
        if len(whole):
            seq[np.concatenate([np.arange(off[i], off[i + 1]) for i in whole])] = len(good)
            seq[off[whole]] = len(good) + 2 + len(heads) + np.arange(len(whole))
        seq = np.insert(seq, off[1:], len(good) + 1)
        each = pa.concat_arrays([ids, pa.array(rest, pa.large_binary())]).take(pa.array(seq))
        docs = off + np.arange(len(off))
    ends = np.frombuffer(each.buffers()[1], np.int64, len(each) + 1, each.offset * 8) // kind.itemsize
    return np.frombuffer(each.buffers()[2], kind)[ends[0] : ends[-1]], ends[docs] - ends[0]


def rolling(ids: np.ndarray) -> np.ndarray:
    """Polynomial hash (mod 2^64) of the ROLL ids from each place on."""
    h, power, have = ids.astype(np.uint64) + np.uint64(1), _P, 1
    while have < ROLL:
        if len(h) <= have:
            return np.empty(0, np.uint64)
        h = h[:-have] * power + h[have:]
        power, have = power * power, have * 2
    return h


def cuts(ids: np.ndarray, off: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each document, relative to its start. A cut depends on the ids of the document alone."""
    h = rolling(ids)
    ends = np.flatnonzero((h >> np.uint64(40)) & np.uint64((1 << LOW_BITS) - 1) == 0) + ROLL
    lo, hi = np.searchsorted(ends, off[:-1] + ROLL), np.searchsorted(ends, off[1:])
    out = []
    for i in range(len(off) - 1):
        own, last, n = [], 0, int(off[i + 1] - off[i])
        for e in (*(ends[lo[i] : hi[i]] - off[i]).tolist(), n):
            while e - last > MOST:
                last += MOST
                own.append(last)
            if e - last >= LEAST and e < n:
                own.append(e)
                last = e
        own.append(n)
        out.append(own)
    return out


def merkle(names: list[bytes]) -> bytes:
    """Root over the names in order; an odd node moves up as it is; the root of nothing is 16 zero bytes."""
    level = [hashlib.blake2b(b"\0" + x, digest_size=16).digest() for x in names] or [bytes(16)]
    while len(level) > 1:
        pairs = [hashlib.blake2b(b"\1" + a + b, digest_size=16).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(level) - len(level) % 2 :]
    return level[0]


KIND = "kind int, deal long, part int, hash binary, blob binary, n long, doc_id long, tie long, hashes array<binary>, ends array<long>"
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("deal", pa.int64()), ("part", pa.int32()), ("hash", pa.binary()), ("blob", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("hashes", pa.list_(pa.binary())), ("ends", pa.list_(pa.int64()))]
)


def _batch(rows: dict) -> pa.RecordBatch:
    n = max(len(v) for v in rows.values())
    return pa.RecordBatch.from_arrays([pa.array(rows.get(f.name, [None] * n), f.type) for f in _SCHEMA], schema=_SCHEMA)


def _encode(path: str):
    def run(it):
        import xxhash
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1, write_content_size=True, write_checksum=False, write_dict_id=False)
        words.claim("tokens", _forget)
        seen: set[bytes] = set()
        for b in (s for x in it for s in words.batches([x], BATCH)):
            ids, off = encode(b.column(1), path)
            texts = words.blobs(b.column(1))
            hashes, lens, names, blobs, sizes = [], [], [], [], []
            for i, ends in enumerate(cuts(ids, off)):
                own, begin = [], int(off[i])
                for s, e in zip((0, *ends), ends, strict=False):
                    raw = ids[begin + s : begin + e].tobytes()
                    h = hashlib.blake2b(raw, digest_size=16).digest()
                    own.append(h)
                    if h not in seen:
                        seen.add(h)
                        names.append(h)
                        blobs.append(squeeze.compress(raw))
                        sizes.append(e - s)
                hashes.append(own)
                lens.append(ends)
            if names:
                yield _batch({"kind": [0] * len(names), "deal": [int.from_bytes(h[:8], "little", signed=True) for h in names], "hash": names, "blob": blobs, "n": sizes})
            ties = [int.from_bytes(xxhash.xxh3_64_digest(t), "little", signed=True) for t in texts]
            ids_ = b.column(0).to_pylist()
            deal = [(t ^ ((d or 0) * 0x9E3779B97F4A7C15)) & ((1 << 63) - 1) for d, t in zip(ids_, ties, strict=True)]
            yield _batch({"kind": [1] * b.num_rows, "deal": deal, "n": np.diff(off).tolist(), "doc_id": ids_, "tie": ties, "hashes": hashes, "ends": lens})

    return run


def _unique(it):
    """Rows sorted by kind and hash: repeats of a chunk go, and the manifest of what stays comes last."""
    part, names, last = TaskContext.get().partitionId(), [], None
    for b in it:
        hashes, kinds = b.column(3).to_pylist(), b.column(0).to_pylist()
        keep = []
        for k, h in zip(kinds, hashes, strict=True):
            keep.append(k != 0 or h != last)
            if k == 0 and h != last:
                names.append(h)
                last = h
        b = b.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([pa.array([part] * b.num_rows, pa.int32()) if f.name == "part" else b.column(f.name) for f in _SCHEMA], schema=_SCHEMA)
    yield _batch({"kind": [2], "deal": [0], "part": [part], "n": [len(names)], "hash": [merkle(names)]})


def write(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode docs (doc_id, text) and write the files described above under path."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encode(tokenizer), KIND)
    dealt = rows.repartition(store.partitions(spark), "deal").sortWithinPartitions("kind", "hash").mapInArrow(_unique, KIND)
    dealt.drop("deal").write.partitionBy("kind").option("compression", "uncompressed").parquet(f"{path}/store")
    recipes = _read(spark, path, 1).select("doc_id", "tie", "n", "hashes", "ends")
    ordered = store.ranked(recipes, [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()], total=F.col("n"), name="order")
    ordered.write.option("compression", "zstd").parquet(f"{path}/recipes")


_FILE = "part int, hash binary, blob binary, n long, doc_id long, tie long, hashes array<binary>, ends array<long>, kind int"


def _read(spark: SparkSession, path: str, kind: int) -> DataFrame:
    return spark.read.schema(_FILE).parquet(f"{path}/store").where(F.col("kind") == kind)


_ORDER = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of polynomials over GF(2) modulo the CRC-32 polynomial, in reflected bit order."""
    a, out = a.astype(np.uint64), np.zeros(len(a), np.uint64)
    b = b.astype(np.uint64)
    one = np.uint64(1)
    for bit in range(31, -1, -1):
        out ^= np.where((a >> np.uint64(bit)) & one, b, np.uint64(0))
        b = np.where(b & one, (b >> one) ^ np.uint64(_ORDER), b >> one)
    return out


def advance(crc: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """What each CRC-32 contributes to the CRC of a text that goes on for ``behind`` bytes."""
    out, n, power = crc.astype(np.uint64), behind.astype(np.int64).copy(), np.array([0x00800000], np.uint64)  # x^8
    while n.any():
        odd = (n & 1).astype(bool)
        if odd.any():
            out[odd] = _times(out[odd], np.repeat(power, int(odd.sum())))
        n >>= 1
        power = _times(power, power)
    return out


def _check(kind):
    def run(it):
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        for b in it:
            crcs, ns = [], []
            for name, blob, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                raw = open_.decompress(blob)
                ids = np.frombuffer(raw, kind)
                if hashlib.blake2b(raw, digest_size=16).digest() != name or len(ids) != n:
                    raise ValueError(f"chunk {name.hex()} is damaged")
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                ns.append(len(ids))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ns, pa.int64()), pa.array(crcs, pa.int64())], names=["hash", "n", "crc"])

    return run


def _advance(crc: pd.Series, behind: pd.Series) -> pd.Series:
    return pd.Series(advance(crc.to_numpy(), behind.to_numpy()).astype(np.int64))


def damaged_parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts whose Merkle root over the names of the chunks that are there is not the manifest's. Normally empty."""

    def root(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "root": [merkle(sorted(x for x in pdf["hash"] if x is not None))]})

    there = _read(spark, path, 0).select("part", "hash").groupBy("part").applyInPandas(root, "part int, root binary")
    said = _read(spark, path, 2).select("part", F.col("hash").alias("said"))
    return said.join(there, "part", "full").where(~F.coalesce("root", F.lit(bytes(16))).eqNullSafe(F.when(F.col("said") == merkle([]), F.lit(bytes(16))).otherwise(F.col("said"))))


def digests(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the stored chunks; a chunk that does not match its name
    or length, or is missing, ends the query."""
    kind = _tokenizer(tokenizer)[1]
    chunks = _read(spark, path, 0).select("hash", "blob", "n").mapInArrow(_check(kind), "hash binary, n long, crc long")
    recipes = spark.read.parquet(f"{path}/recipes")
    parts = recipes.select("rank", "n", F.explode(F.arrays_zip("hashes", "ends")).alias("x")).select("rank", F.col("x.hashes").alias("hash"), (F.col("n") - F.col("x.ends")).alias("behind"))
    read = parts.join(chunks.withColumnRenamed("n", "len"), "hash", "left")
    crc = F.pandas_udf(_advance, "long")(F.coalesce("crc", F.raise_error(F.lit("a chunk is missing")).cast("long")), F.col("behind") * 4)
    sums = read.select("rank", "len", crc.alias("crc")).groupBy("rank").agg(F.sum("len").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    out = recipes.select("rank", "doc_id", F.col("before").alias("start")).join(sums, "rank")
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def documents(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """rank, doc_id, ids (array<int>) of each document, put together from its chunks; a document is one row."""
    kind = _tokenizer(tokenizer)[1]

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        pdf = pdf.sort_values("seq")
        raw = b"".join(open_.decompress(x) for x in pdf["blob"])
        return pd.DataFrame({"rank": [int(pdf["rank"].iloc[0])], "ids": [np.frombuffer(raw, kind).astype(np.int32).tolist()]})

    recipes = spark.read.parquet(f"{path}/recipes")
    parts = recipes.select("rank", F.posexplode("hashes").alias("seq", "hash"))
    whole = parts.join(_read(spark, path, 0).select("hash", "blob"), "hash").groupBy("rank").applyInPandas(join, "rank long, ids array<int>")
    return recipes.select("rank", "doc_id").join(whole, "rank")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def stored(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write docs to a new store in the shared folder, verify its manifests and read it back."""
    spark = docs.sparkSession
    path = store.place(spark, "tokens")
    write(docs, tokenizer, path)
    if bad := damaged_parts(spark, path).take(1):
        raise ValueError(f"part {bad[0]['part']} of {path} is not what its manifest says")
    return digests(spark, path, tokenizer)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the store holds: doc_id, start, n_tokens, ids_crc32 of each document."""
    return stored(docs, tokenizer_path())
