"""Per-receipt group statistics (W1-W4) without windows over hot keys.

The reference attaches to each receipt counts over (user), (user, coupon),
(user, day) and (user, coupon, day), first/last flags and the day gaps to
the nearest other receipt of the same coupon.  A window partitioned by
``user`` would put all of a heavy user's rows into one task.  Instead:

1. aggregate the receipts to the (user, coupon, day) grain -- a hash
   aggregate with map-side partial counts, so a key holding a third of
   all rows is combined before it is shuffled;
2. roll that table up to (user, day), and that to (user), with further
   aggregates (``receipt_day_stats``; what needs no such totals uses
   ``pair_day_stats``);
3. run the only window over (user, coupon) on the deduplicated table,
   where each group holds at most one row per calendar day;
4. callers join the result back on (user, coupon, day) exactly once
   (AQE splits a skewed partition of that join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

U, C, D = "user_id", "coupon_id", "date_received"


def pair_day_stats(rows: DataFrame, user: str = U, coupon: str = C, day: str = D, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct (user, coupon, day) of ``rows``: n_ucd, n_uc (receipt
    counts), first_day, last_day (of the (user, coupon) group), prev_day, next_day
    (nearest other distinct receipt day of the same pair, null if none).  ``by``
    names non-null columns that keep several sets of receipts apart."""
    ucd = (rows.where(F.col(user).isNotNull() & F.col(coupon).isNotNull() & F.col(day).isNotNull())
               .groupBy(*by, user, coupon, day).agg(F.count(F.lit(1)).alias("n_ucd")))
    w = Window.partitionBy(*by, user, coupon)
    wo = w.orderBy(day)
    return ucd.select(
        "*",
        F.sum("n_ucd").over(w).alias("n_uc"),
        F.min(day).over(w).alias("first_day"),
        F.max(day).over(w).alias("last_day"),
        F.lag(day).over(wo).alias("prev_day"),
        F.lead(day).over(wo).alias("next_day"),
    )


def receipt_day_stats(rows: DataFrame, user: str = U, coupon: str = C, day: str = D, by: tuple[str, ...] = ()) -> DataFrame:
    """``pair_day_stats`` with n_ud and n_u, the receipts of the (user, day) and of
    the user."""
    ucd = pair_day_stats(rows, user, coupon, day, by)
    # (user, day) totals, then user totals rolled up from those; the two
    # small tables are joined first (a user has at most one row per day),
    # so the (user, coupon, day) table is joined -- and shuffled -- once
    ud = ucd.groupBy(*by, user, day).agg(F.sum("n_ucd").alias("n_ud"))
    u = ud.groupBy(*by, user).agg(F.sum("n_ud").alias("n_u"))
    return ucd.join(ud.join(u, [*by, user]), [*by, user, day])


def first_last_flags(stats: DataFrame, day: str = D) -> DataFrame:
    """W1 on a ``receipt_day_stats`` table: 1 on the group's last (first)
    day, 0 on another day, -1 when the pair was received only once."""
    once = F.col("n_uc") <= 1
    return stats.select(
        "*",
        F.when(once, -1).when(F.col(day) == F.col("last_day"), 1).otherwise(0)
         .alias("this_month_user_receive_same_coupon_lastone"),
        F.when(once, -1).when(F.col(day) == F.col("first_day"), 1).otherwise(0)
         .alias("this_month_user_receive_same_coupon_firstone"),
    )


def day_gaps(stats: DataFrame, day: str = D) -> DataFrame:
    """Days to the nearest earlier / later receipt day, -1 if none.
    Same-day repeats do not count (a gap must be positive)."""
    return stats.select(
        "*",
        F.coalesce(F.datediff(F.col(day), F.col("prev_day")), F.lit(-1)).alias("day_gap_before"),
        F.coalesce(F.datediff(F.col("next_day"), F.col(day)), F.lit(-1)).alias("day_gap_after"),
    )


def date_lists(rows: DataFrame, user: str = U, coupon: str = C, day: str = D) -> DataFrame:
    """Per (user, coupon) the receipt days in order with their counts, as
    ``days: array<struct<day, n>>`` -- one entry per distinct day, however often a day
    repeats."""
    ucd = (rows.where(F.col(user).isNotNull() & F.col(coupon).isNotNull() & F.col(day).isNotNull())
               .groupBy(user, coupon, day).agg(F.count(F.lit(1)).alias("n")))
    return ucd.groupBy(user, coupon).agg(
        F.sort_array(F.collect_list(F.struct(F.col(day).alias("day"), F.col("n").alias("n")))).alias("days"))


def date_list_text(lists: DataFrame) -> DataFrame:
    """The same as text: ``dates``, ``yyyyMMdd:count`` pairs joined by ``,``, and ``days_text``, the
    days alone joined by ``:``, each once (as long as a pair's distinct days are many)."""
    pairs = F.transform("days", lambda x: F.concat(F.date_format(x["day"], "yyyyMMdd"), F.lit(":"), x["n"]))
    alone = F.transform("days", lambda x: F.date_format(x["day"], "yyyyMMdd"))
    return lists.withColumns({"dates": F.array_join(pairs, ","), "days_text": F.array_join(alone, ":")}).drop("days")
