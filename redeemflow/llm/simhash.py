"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into four quarters.  Of at most three differing bits
some quarter has none (pigeonhole); the other 48 bits form two segments of
24, and one of those has at most one.  The first 23 bits of that segment are a
word of the perfect binary Golay code, where every word lies within distance
three of exactly one codeword.  A segment is stored under the index of its own
codeword and looked up under the codewords of itself and of its 23 one-bit
neighbours: one index if it lies within distance two of its codeword, six
otherwise.  Two segments one bit apart therefore always meet.  A key joins the
intact quarter with the codeword index; candidates are verified by counting
differing bits.

Only distinct fingerprints are joined, so copies cost one row.  Documents are
grouped by connected components over the links.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import connected_components, cut

#: shingles hashed at once: bounds the memory a very long text needs
CHUNK_WORDS = 1 << 16
#: generator polynomial of the (23, 12) Golay code: x^11+x^10+x^6+x^5+x^4+x^2+1 (fixed value)
GENERATOR = 0b110001110101

_MASK16 = np.uint64(0xFFFF)


# ------------------------------------------------------------- fingerprints
def fingerprint(data: bytes | None, shingle: int = 3) -> int:
    """SimHash of the XXH64 (seed 42) values of a text's word shingles."""
    words = (data or b"").lower().split()  # bytes: A-Z only; the six ASCII spaces
    n = len(words)
    if n == 0:
        return 0
    k = min(shingle, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n - k + 1, CHUNK_WORDS):
        part = words[lo:lo + CHUNK_WORDS + k - 1]
        text = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[:len(part) - k + 1]
        slices = map(slice, starts.tolist(), (ends[k - 1:] - 1).tolist())
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(text.__getitem__, slices), repeat(42)),
                        np.uint64, len(starts))
        for at in range(0, len(h), 4096):
            bits = np.unpackbits(h[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n - k + 1, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, shingle):
    for b in batches:
        fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("data")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_key"), pa.array(fp.view(np.int64))],
            ["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_key, fp`` (the 64 bits as a signed long) for every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("binary").alias("data"))
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id long, text_key long, fp long")


# --------------------------------------------------------------- Golay code
@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of ``m * x^11`` by the generator for each 12-bit message, and
    the error pattern of each remainder."""
    m = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        m = np.where(m >> bit & 1, m ^ (GENERATOR << (bit - 11)), m)
    parity = m.astype(np.int32)
    errors = np.zeros(1 << 11, np.int32)
    for weight in range(1, 4):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            errors[parity[e >> 11] ^ (e & 0x7FF)] = e
    return parity, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0..4095) of the codeword within distance three of each 23-bit word."""
    parity, errors = _golay()
    words = words.astype(np.int32)
    return (words ^ errors[parity[words >> 11] ^ (words & 0x7FF)]) >> 11


def _segments(fp: np.ndarray):
    """``(table, quarter, 23-bit word)`` of the eight tables."""
    q = [(fp >> np.uint64(16 * i)) & _MASK16 for i in range(4)]
    for i in range(4):
        a, b, c = (q[j].astype(np.int64) for j in range(4) if j != i)
        rest = a | b << 16 | c << 32
        for half in range(2):
            yield 2 * i + half, q[i].astype(np.int64), (rest >> (24 * half)) & 0x7FFFFF


def _keys(batches, probe):
    """Rows ``fp, key``: one key per table to store, one to six to look up."""
    near = [0] + [1 << b for b in range(23)] if probe else [0]
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for table, quarter, word in _segments(fp.view(np.uint64)):
            idx = np.sort(np.stack([decode(word ^ e) for e in near], axis=1), axis=1)
            new = np.ones(idx.shape, bool)
            new[:, 1:] = idx[:, 1:] != idx[:, :-1]
            key = (np.int64(table) << 28) | (quarter[:, None] << 12) | idx
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.broadcast_to(fp[:, None], idx.shape)[new]), pa.array(key[new])], ["fp", "key"])


def keys(fps: DataFrame, probe: bool) -> DataFrame:
    return fps.select("fp").mapInArrow(lambda it: _keys(it, probe), "fp long, key long")


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Distinct pairs ``a < b`` of the distinct fingerprints ``fps`` that differ in at
    most ``distance`` (up to three) bits."""
    if not 0 <= distance <= 3:
        raise ValueError("the pigeonhole split serves up to three differing bits")
    stored = keys(fps, False).select(F.col("fp").alias("a"), "key")
    looked_up = keys(fps, True).select(F.col("fp").alias("b"), "key")
    return (stored.join(looked_up, "key").where("a < b")
            .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
            .select("a", "b").distinct())


# --------------------------------------------------------------- duplicates
def group(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits),
    ``component_id`` (the smallest doc_id reachable over links, itself included),
    ``component_fp`` (the component's own key), ``text_key`` (a hash of the text).

    Defined cases: a null or empty text, or one without words, has fingerprint
    zero and is linked like any other; rows with a null doc_id keep it, link like
    others and are never a component's smallest id unless it has no other;
    repeated rows each get the same result; other columns are ignored.
    """
    rows = cut(fingerprints(docs, shingle))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comps = connected_components(links(fps, distance).select(F.col("a").alias("u"), F.col("b").alias("v")))
    fps = (fps.join(comps, fps.fp == comps.node, "left")
           .select("fp", "low", F.coalesce("component", "fp").alias("component_fp")))
    ids = fps.groupBy("component_fp").agg(F.min("low").alias("component_id"))
    by_fp = fps.select("fp", "component_fp").join(ids, "component_fp")
    return rows.join(by_fp, "fp").select(
        "doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id", "component_fp", "text_key")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """Rows of ``docs`` with one document of each group kept: the smallest doc_id
    (null only if the group has no other).  Of repeated rows of that id one stays."""
    same = (group(docs, shingle, distance).groupBy("component_fp", "doc_id", "text_key")
            .agg(F.count("*").alias("n")))
    best = same.groupBy("component_fp").agg(
        F.min(F.struct(F.isnull("doc_id"), "doc_id", "text_key", "n")).alias("x"))
    best = best.select(F.col("x.doc_id").alias("_id"), F.col("x.text_key").alias("_key"),
                       F.col("x.n").alias("_n"))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_text_key"))
    stay = rows.join(best, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key")))
    once, more = stay.where("_n = 1"), stay.where("_n > 1")
    return (once.select("_row").unionByName(more.dropDuplicates(["doc_id", "text"]).select("_row"))
            .select("_row.*"))
