"""Token counts by a two-tier lookup on the map side.

A text's tokens are counted pre-token by pre-token, since no merge crosses the
bounds between them.  The lengths of the corpus's frequent pre-tokens travel to
every worker as one compact table; a pre-token that is not in it is encoded where
it is met, and the worker remembers the latest such lengths.  No pre-token is ever
shuffled: tasks exchange only their bounded lists of frequent ones.

The table only saves time.  Counts are those of ``sentencepiece`` on the whole text
whatever it holds.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import fold

#: entries of the broadcast table, and of the list that one task hands on
FREQUENT = 65_536
TASK_FREQUENT = 8_192
#: pre-tokens that a task counts at a time, and lengths that a worker remembers
COUNTED = 262_144
REMEMBERED = 262_144
#: longest pre-token (code points) that is counted or remembered
LONGEST = 48

SPACE = "▁"  # how the library writes a space
_UNIT = re.compile(r"\n[^\n ]*| +[^\n ]*")
_SUMMARY = "keys binary, ends binary, counts binary"
_COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


@lru_cache(2)
def _encoder(model: str):
    """Encoder of a ``sentencepiece`` file, and whether a text may be counted in parts.

    Parts are exact if texts are taken as they are with one space in front, no
    piece has a space after another character, and none holds a line feed.
    """
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    probe = " ａ  é\n "
    in_parts = (sp.normalize(probe) == SPACE + probe.replace(" ", SPACE)
                and not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces))
    return sp, in_parts


def pre_tokens(text: str) -> list[str]:
    r"""Pre-tokens of a non-empty text, each as the string that ``length_of`` takes.

    A pre-token is a run of spaces and the characters after it, or a line feed
    and the characters after it; it is written without its first space.  The
    space that the library puts before a text belongs to the first one.
    """
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if "  " not in text and " \n" not in text and text[0] not in " \n" and text[-1] != " ":
        return text.replace("\n", " \n").split(" ")  # every run has one space
    return [u if u[0] == "\n" else u[1:] for u in _UNIT.findall(" " + text)]


def length_of(unit: str, sp) -> int:
    """Tokens of one pre-token."""
    if not unit:
        return 1  # a space alone
    n = len(sp.encode(unit))
    return n - 1 if unit[0] == "\n" else n  # the space in front is not its own


class Lengths(dict):
    """Lengths of the frequent pre-tokens; others are encoded and remembered, up to
    a bound at which the memory starts anew."""

    def __init__(self, known, sp):
        super().__init__(known)
        self.sp, self.recent = sp, {}

    def __missing__(self, unit):
        n = self.recent.get(unit)
        if n is None:
            n = length_of(unit, self.sp)
            if len(unit) <= LONGEST:
                if len(self.recent) >= REMEMBERED:
                    self.recent.clear()
                self.recent[unit] = n
        return n


# ------------------------------------------------------- the frequent pre-tokens
def _summary(counts: Counter, size: int) -> pa.RecordBatch:
    """The most frequent keys as one row: joined bytes, where each ends, counts."""
    top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]
    keys = [k.encode() for k, _ in top]
    ends = np.cumsum([len(k) for k in keys], dtype="<u4")
    row = [b"".join(keys), ends.tobytes(), np.array([n for _, n in top], "<i8").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], ["keys", "ends", "counts"])


def _entries(keys: bytes, ends: bytes) -> list[str]:
    stops = np.frombuffer(ends, "<u4").tolist()
    return [keys[a:b].decode() for a, b in zip([0, *stops], stops)]


def _prune(counts: Counter) -> Counter:
    return Counter(dict(counts.most_common(COUNTED // 2))) if len(counts) > COUNTED else counts


def _task_summary(batches):
    counts: Counter = Counter()
    for b in batches:
        for text in b.column(0):
            text = text.as_py()
            if text:
                counts.update(pre_tokens(text))
                counts = _prune(counts)
    for k in [k for k in counts if len(k) > LONGEST]:
        del counts[k]
    if counts:
        yield _summary(counts, TASK_FREQUENT)


def _merge_summaries(batches, size):
    counts: Counter = Counter()
    for b in batches:
        for r in b.to_pylist():
            for k, n in zip(_entries(r["keys"], r["ends"]), np.frombuffer(r["counts"], "<i8").tolist()):
                counts[k] += n
            counts = _prune(counts)
    if counts:
        yield _summary(counts, size)


class Table(NamedTuple):
    """Frequent pre-tokens, where each ends, and their numbers of tokens."""
    keys: bytes
    ends: bytes
    lengths: bytes


def frequent_table(texts: DataFrame, model: str, size: int = FREQUENT) -> Table:
    """The corpus's most frequent pre-tokens with their lengths.

    Every text is counted.  A task hands on its ``TASK_FREQUENT`` most frequent ones
    in one row; rows are merged by ``fold``, so the driver gets one row of at most
    ``size`` entries of ``LONGEST`` code points.
    """
    sp, in_parts = _encoder(model)
    if not in_parts:
        return Table(b"", b"", b"")
    rows = fold(texts.mapInArrow(_task_summary, _SUMMARY), lambda it: _merge_summaries(it, size), _SUMMARY).collect()
    if not rows:
        return Table(b"", b"", b"")
    keys, ends = bytes(rows[0]["keys"]), bytes(rows[0]["ends"])
    return Table(keys, ends, np.array([length_of(k, sp) for k in _entries(keys, ends)], "<u2").tobytes())


# --------------------------------------------------------------------- counting
@lru_cache(1)
def _lengths(table: Table, model: str) -> Lengths:
    sp, _ = _encoder(model)
    return Lengths(zip(_entries(table.keys, table.ends), np.frombuffer(table.lengths, "<u2").tolist()), sp)


def count_tokens(text: str, model: str, table: Table = Table(b"", b"", b"")) -> int:
    if not text:
        return 0
    sp, in_parts = _encoder(model)
    if not in_parts:
        return len(sp.encode(text))
    return sum(map(_lengths(table, model).__getitem__, pre_tokens(text)))


def _count(batches, shared, model, limit):
    names = [f.split(" ")[0] for f in _COUNTS.split(", ")]
    table = Table(*shared.value)
    for b in batches:
        texts = b.column(1)
        n = np.array([count_tokens(t.as_py(), model, table) for t in texts], np.int64)
        size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], names)


def token_counts(docs: DataFrame, model: str, limit: int = 4096, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text, one row per row.

    ``model`` is the path of a ``sentencepiece`` file that every worker can read.
    Defined cases: a null or empty text has 0 bytes and 0 tokens; a text is never
    truncated, however long; repeated rows and null ids are rows of their own;
    control strings in a text are ordinary text, as the library has it; a model
    whose pieces cross pre-tokens is given whole texts; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = frequent_table(rows.select("text"), model, frequent)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(table))
    return rows.mapInArrow(lambda it: _count(it, shared, model, limit), _COUNTS)
