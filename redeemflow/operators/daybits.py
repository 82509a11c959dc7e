"""Exact distinct counts over many windows from one table of day bitmaps (A3).

A distinct count per window is an aggregate of its own for every window.  Here each
(key, value) pair keeps one bit per day on which it occurs; bits of parts of the log are
OR-ed, so the table is built with one combined shuffle, can be merged with the
bits of later days, and answers every window by a mask.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


def _day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def day_bits(rows: DataFrame, keys: list[str], value: str, day: str, origin: str, days: int,
             marks: dict[str, Column]) -> DataFrame:
    """``keys, value`` and, per mark, ``ceil(days / 64)`` long columns ``<mark>_<i>``: bit d of the
    words is set if a row with the mark's condition lies d days after ``origin``.  Rows
    beyond the span are no part of the table; null values are no values.
    """
    at = F.datediff(F.col(day), F.lit(origin).cast("date"))
    rows = rows.where(F.col(value).isNotNull()).select(*keys, value, at.alias("_d"), *[c.alias(f"_{m}") for m, c in marks.items()])
    rows = rows.where(F.col("_d").between(0, days - 1))
    one = F.lit(1).cast("long")
    bits = []
    for m in marks:
        for i in range(-(-days // WORD)):
            here = F.col(f"_{m}") & (F.floor(F.col("_d") / WORD) == i)
            bit = F.call_function("shiftleft", one, (F.col("_d") % WORD).cast("int"))
            bits.append(F.coalesce(F.bit_or(F.when(here, bit)), F.lit(0).cast("long")).alias(f"{m}_{i}"))
    return rows.groupBy(*keys, value).agg(*bits)


def merge_bits(keys: list[str], value: str, *tables: DataFrame) -> DataFrame:
    """One table of several, of other days or the same ones (of one origin)."""
    keys, out = [*keys, value], tables[0]
    words = [c for c in out.columns if c not in keys]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(*keys).agg(*[F.bit_or(w).alias(w) for w in words])


def _masks(origin: str, first: str, last: str, words: int) -> list[int]:
    """Words with the bits of the days from ``first`` to ``last`` set, as signed longs."""
    lo, hi = (max(0, min(words * WORD, (_day(x) - _day(origin)).days + add)) for x, add in ((first, 0), (last, 1)))
    bits = ((1 << hi) - 1) & ~((1 << lo) - 1) if hi > lo else 0
    out = [bits >> (WORD * i) & (2 ** WORD - 1) for i in range(words)]
    return [w - 2 ** WORD if w >= 2 ** (WORD - 1) else w for w in out]


def distinct_counts(bits: DataFrame, keys: list[str], origin: str, days: int, marks: list[str],
                    windows: dict[str, tuple[str, str]]) -> DataFrame:
    """``keys, part, <mark>...``: distinct values per key and window (``windows``: name -> first and
    last day, inclusive), rows where the first mark's count is above 0.

    One aggregate for all windows and marks; its rows go out one per key and window.
    """
    words = -(-days // WORD)

    def seen(mark, mask):
        hit = F.lit(False)
        for i, w in enumerate(mask):
            if w:
                hit = hit | (F.col(f"{mark}_{i}").bitwiseAND(F.lit(w).cast("long")) != 0)
        return F.count(F.when(hit, 1))
    aggs = [seen(m, _masks(origin, first, last, words)).alias(f"{m}:{name}")
            for name, (first, last) in windows.items() for m in marks]
    wide = bits.groupBy(*keys).agg(*aggs)
    parts = F.array(*[F.struct(F.lit(name).alias("part"), *[F.col(f"`{m}:{name}`").alias(m) for m in marks])
                      for name in windows])
    return (wide.select(*keys, F.explode(parts).alias("_p")).select(*keys, "_p.*").where(F.col(marks[0]) > 0))
