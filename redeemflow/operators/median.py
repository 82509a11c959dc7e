"""Exact medians by counted selection (A5).

``median`` keeps all values of a group in one buffer.  Here values are counted
first, which Spark combines before the shuffle, and the middle ranks are looked up
among the counts in two steps: prefix sums over ranges of values name the range
that holds a group's middle, and prefix sums inside that range alone name the value.
No task holds more than one range of one group, so a group with a third of all
rows and only distinct values is selected from in as many tasks as its ranges are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from redeemflow.operators.ml import _bucket_of
from redeemflow.session import ensure_checkpoint_dir

#: (group, value) rows that one task sorts, and ranges at most
RANGE_ROWS = 1_000_000
MAX_RANGES = 4096


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, value, n``: how often each non-null value is there."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def counted_median(counts: DataFrame, keys: list[str], value: str, n: str = "n", out: str = "median",
                   ranges: int | None = None) -> DataFrame:
    """``keys, out``: the median (double) of each group of a table of counted values, the
    mean of the two middle values where their number is even.

    ``counts`` may hold a value more than once (counts of days, say).  Groups with a
    null key are groups.  ``ranges`` 1 skips the first step: for values of a small
    domain.  Unset, the counts are written to the checkpoint folder and their
    number decides.
    """
    counts = counts.where(F.col(value).isNotNull() & (F.col(n) > 0)).groupBy(*keys, F.col(value).alias("_v")).agg(
        F.sum(n).cast("long").alias("_n"))
    if ranges != 1:
        ensure_checkpoint_dir(counts.sparkSession)
        counts = counts.checkpoint()
        if ranges is None:
            ranges = min(MAX_RANGES, -(-counts.count() // RANGE_ROWS))
    if ranges <= 1:
        ranked = counts.select("*", F.lit(0).cast("long").alias("_before"), *_middles(keys, "_n"))
        return _select(ranked, keys, [], out)
    probs = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(counts.select(F.percentile_approx(F.col("_v").cast("double"), probs, 10000)).first()[0] or [0.0]))
    placed = counts.withColumn("_r", _bucket_of(F.col("_v").cast("double"), bounds))
    run = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_r").agg(F.sum("_n").alias("_t"))  # at most `ranges` rows a group
    totals = totals.select("*", F.coalesce(F.sum("_t").over(run), F.lit(0)).alias("_before"), *_middles(keys, "_t"))
    middle = totals.where(_holds("_before", "_t", "_lo") | _holds("_before", "_t", "_hi"))
    names = [f"_k{i}" for i in range(len(keys))]
    middle = middle.select(*[F.col(k).alias(m) for k, m in zip(keys, names)], F.col("_r").alias("_mr"), "_before", "_lo", "_hi")
    same = F.col("_r") == F.col("_mr")
    for k, m in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(m))
    return _select(placed.join(middle, same).drop(*names, "_mr"), keys, ["_r"], out)


def _middles(keys, n):
    """The two middle ranks of a group, from 1 (equal for an odd number)."""
    total = F.sum(n).over(Window.partitionBy(*keys))
    return [F.floor((total + 1) / 2).alias("_lo"), F.floor((total + 2) / 2).alias("_hi")]


def _holds(before, n, rank):
    return (F.col(before) < F.col(rank)) & (F.col(rank) <= F.col(before) + F.col(n))


def _select(rows: DataFrame, keys: list[str], within: list[str], out: str) -> DataFrame:
    """The values at the middle ranks, by prefix sums from ``_before`` on."""
    run = Window.partitionBy(*keys, *within).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    at = rows.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(run), F.lit(0)))
    lo, hi = (F.max(F.when(_holds("_at", "_n", rank), F.col("_v"))) for rank in ("_lo", "_hi"))
    return at.groupBy(*keys).agg(((lo.cast("double") + hi.cast("double")) / 2).alias(out))
