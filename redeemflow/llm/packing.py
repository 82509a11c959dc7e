"""Packing into fixed windows by minimum bin slack.

A document's tokens are cut into full windows and one remainder.  The
remainders are known by their length alone, so the plan needs only how many
there are of each (at most ``window`` numbers).  For one window after the other
the longest remaining length is set and a bitset subset-sum dynamic program
over the remaining multiset finds the fill closest to capacity; backtracking
gives how often each length is used.  The multiset found is applied as often as
the counts allow, so the plan grows with the number of lengths, not with the
number of documents.

Pieces then take their places by rank within their length class.  Ranks come
from counts per (length, salt), so no class is ranked in one task.
"""

from __future__ import annotations

import base64
import os
import re
import sys
import zlib
from array import array
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from redeemflow.llm.common import cut

#: pieces of one length that are ranked together
RANK_GROUP = 10_000

_BEYOND_LATIN = re.compile("[^\\x00-\\u024f]")
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
_PLACED = _PIECE + ", sequence_id long, offset long"


# ---------------------------------------------------------------- tokenising
class Files(NamedTuple):
    """A byte-level BPE: the ``tokenizers`` file, and optionally the same
    vocabulary as ranks with its pattern."""
    tokenizer: str
    ranks: str | None = None
    pattern: str | None = None


@lru_cache(2)
def _encoders(files: Files):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    def encoder(ordinary):
        tok = Tokenizer.from_file(files.tokenizer)
        tok.encode_special_tokens = ordinary  # their strings in a text are ordinary text
        return tok, lambda text: tok.encode(text, add_special_tokens=False).ids
    tok, whole = encoder(False)
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    # no added token: a pattern that matches nothing
    holds_added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
    _, encode = encoder(True)
    if files.ranks is None:
        return whole, holds_added, encode, encode
    import tiktoken
    with open(files.ranks, "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in (line.split() for line in f)}
    fast = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
    return whole, holds_added, encode, fast.encode_ordinary


def token_bytes(text: str | None, files: Files, added: bool = False) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit bytes.

    The ids are those of ``tokenizers``.  Where the rank file is given, texts of
    Latin letters are encoded with it: same vocabulary, same pattern, same ids
    (tests compare them), three times faster.  Other texts, whose letters the
    two libraries might class by different Unicode versions, go to ``tokenizers``.

    With ``added``, a text that holds the string of an added token (such as
    ``<|endoftext|>``) goes to the unmodified ``tokenizers`` file and gets that
    token's id; without, the string is ordinary text.
    """
    if not text:
        return b""
    whole, holds_added, encode, fast = _encoders(files)
    if added and holds_added.search(text):
        encode = fast = whole
    ids = array("I", (encode if _BEYOND_LATIN.search(text) else fast)(text))
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def _pieces(batches, files, window, end_id):
    names = [f.split(" ")[0] for f in _PIECE.split(", ")]
    end = np.array([end_id], "<u4").tobytes()
    for b in batches:
        out = []
        for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            ids = token_bytes(text.as_py(), files, added=True) + end
            n = len(ids) // 4
            for start in range(0, n, window):
                part = ids[4 * start:4 * (start + window)]
                out.append((doc_id, start, len(part) // 4, zlib.crc32(part), n))
        cols = list(zip(*out)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def cut_documents(docs: DataFrame, files: Files, window: int = 2048, end_id: int = 1) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` per piece: the full windows
    of a document and its remainder.  The ids are those of the unmodified
    ``tokenizers`` file, added tokens included."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(lambda it: _pieces(it, files, window, end_id), _PIECE)


# ------------------------------------------------------------------ planning
def best_fill(counts: dict[int, int], capacity: int) -> Counter:
    """Multiset of lengths with the largest sum up to ``capacity``.

    ``counts`` says how often each length is there.  ``reach`` is a bitset of the
    sums that the lengths so far can give; the steps are kept and walked back.
    """
    reach, full, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x]), reverse=True):
        left, k = min(counts[length], capacity // length), 1
        while left:  # 1, 2, 4, ... copies: any number up to `left`
            k = min(k, left)
            grown = (reach | reach << (length * k)) & full
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            left -= k
            k *= 2
        if reach >> capacity & 1:
            break
    at, fill = reach.bit_length() - 1, Counter()
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            fill[length] += k
            at -= length * k
    return fill


def plan_windows(histogram: dict[int, int], window: int) -> list[tuple[Counter, int]]:
    """``(multiset of lengths, how many windows are filled with it)``."""
    counts = {k: v for k, v in histogram.items() if v}
    plan = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        fill = best_fill(counts, window - first)
        counts[first] += 1
        fill[first] += 1
        times = min(counts[x] // m for x, m in fill.items())
        plan.append((fill, times))
        for x, m in fill.items():
            counts[x] -= m * times
            if not counts[x]:
                del counts[x]
    return plan


def _places(plan) -> dict[int, np.ndarray]:
    """Per length, rows ``first rank, copies per window, first sequence, offset``."""
    rows: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for fill, times in plan:
        offset = 0
        for x, m in sorted(fill.items(), reverse=True):
            rows.setdefault(x, []).append((used[x], m, sequence, offset))
            used[x] += m * times
            offset += m * x
        sequence += times
    return {x: np.array(r, np.int64) for x, r in rows.items()}


def _place(batches, places):
    names = [f.split(" ")[0] for f in _PLACED.split(", ")]
    for b in batches:
        length = b.column("length").to_numpy(zero_copy_only=False)
        rank = b.column("rank").to_numpy(zero_copy_only=False)
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            mine, rows = length == x, places[int(x)]
            r = rank[mine]
            row = rows[np.searchsorted(rows[:, 0], r, "right") - 1]
            seq[mine] = row[:, 2] + (r - row[:, 0]) // row[:, 1]
            off[mine] = row[:, 3] + (r - row[:, 0]) % row[:, 1] * x
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in names[:5]] + [pa.array(seq), pa.array(off)], names)


def pack(docs: DataFrame, files: Files, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces with their place: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    Defined cases: a null or empty text is the end id alone; a very long text
    gives many full windows; repeated rows are packed each on their own (a null
    doc_id is kept); other columns are ignored; an empty table gives no rows.
    """
    pieces = cut(cut_documents(docs, files, window, end_id))
    sizes = pieces.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in sizes.collect()}  # at most `window` rows
    places = _places(plan_windows(histogram, window))
    salts = F.broadcast(sizes.select("length", F.ceil(F.col("count") / RANK_GROUP).alias("salts")))
    salted = (pieces.join(salts, "length")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("salts"))))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(F.col("length").alias("g_length"), F.col("salt").alias("g_salt"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (salted.withColumn("n", F.row_number().over(order))
              .join(groups, (F.col("length") == F.col("g_length")) & (F.col("salt") == F.col("g_salt")))
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("base") + F.col("n") - 1).alias("rank")))
    return ranked.mapInArrow(lambda it: _place(it, places), _PLACED)
