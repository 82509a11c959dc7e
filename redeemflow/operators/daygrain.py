"""Feature blocks from day-grain partials (F1, F2 with A1, A2, A4, A7).

The blocks of every split are aggregates of the same rows over other days.  Each family
gets one table of partial results per key and day: counts, sums, minima and maxima,
which can be merged, with the keys that distinct counts and medians need kept apart.
A split's blocks are rolled up from the partials of its days, and a day that is added to
the log adds its own partials.  Rows are tagged with every window that holds their day, so
one pass gives the blocks of all splits, each row with its ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF
from redeemflow.operators import blocks_b as B
from redeemflow.operators.blocks_a import _count_if, _nz, has_coupon, has_date, has_received
from redeemflow.operators.split import A_SETS, B_SPLITS, _plus

#: windows by name, first and last day inclusive
A_WINDOWS = {f"set{n}": s.features for n, s in A_SETS.items()}
B_WINDOWS = {name: (s.history[0], _plus(s.history[0], s.history[1] - 1)) for name, s in B_SPLITS.items()}


def in_windows(grain: DataFrame, windows: dict[str, tuple[str, str]], day: str = "day") -> DataFrame:
    """One copy of a row per window that holds its day, with the window's name in ``part``."""
    lo, hi = min(w[0] for w in windows.values()), max(w[1] for w in windows.values())
    if len(windows) == 1:
        return grain.where(F.col(day).between(RF.lit_date(lo), RF.lit_date(hi))).select(
            F.lit(next(iter(windows))).alias("part"), *grain.columns)
    names = F.array(*[F.when(F.col(day).between(RF.lit_date(a), RF.lit_date(b)), F.lit(name))
                      for name, (a, b) in windows.items()])
    kept = grain.where(F.col(day).between(RF.lit_date(lo), RF.lit_date(hi)))
    return kept.select(F.explode(F.array_compact(names)).alias("part"), *grain.columns)


#: rows of a grain that one task merges (a row of merged partials takes some 200 bytes)
TASK_ROWS = 1_000_000


def _dealt(grain: DataFrame, tasks: bool, *keys: str) -> DataFrame:
    """The grain dealt by ``keys``, before its rows are copied into windows: few rows share a day's
    keys, so merging them where they are read would hold nearly all of a task's rows without
    making them fewer.  With ``tasks`` the rows (of a stored grain: its footers know) say in
    how many parts."""
    if not tasks:
        return grain.repartition(*keys)
    n = max(grain.sparkSession.sparkContext.defaultParallelism, -(-grain.count() // TASK_ROWS))
    return grain.repartition(n, *keys)


def _ranged(rows: DataFrame, files: int | None) -> DataFrame:
    """Rows in ``files`` ranges of (day, user), which aggregates by these and other keys keep."""
    return rows if files is None else rows.repartitionByRange(files, "day", "user_id")


# ---------------------------------------------------------------- Family A
def a_grain(log: DataFrame, files: int | None = None) -> DataFrame:
    """Partials per (user, merchant, distance of a used receipt, day); the day is the one on
    which the row counts in Family A's feature windows."""
    used = has_date() & has_coupon()
    gap = F.when(has_date() & has_received(), F.datediff("date", "date_received"))
    rows = log.where(has_date() | has_received()).withColumn("day", F.coalesce("date", "date_received"))
    return (_ranged(rows, files)
            .groupBy("user_id", "merchant_id", F.when(used, F.col("distance")).alias("distance"), "day")
            .agg(F.count(F.lit(1)).alias("n"), _count_if(has_date()).alias("n_date"),
                 _count_if(has_coupon()).alias("n_coupon"), _count_if(used).alias("n_used"),
                 _count_if(has_date() & has_received()).alias("n_both"),
                 _count_if(has_date() & ~has_coupon()).alias("n_common"),
                 F.sum(gap).alias("gap_sum"), F.min(gap).alias("gap_min"), F.max(gap).alias("gap_max")))


_A_SUMS = ["n", "n_date", "n_coupon", "n_used", "n_both", "n_common", "gap_sum"]


def _merged(rows: DataFrame, keys: list[str], *more) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _A_SUMS], F.min("gap_min").alias("gap_min"),
                                   F.max("gap_max").alias("gap_max"), *more)


def a_pairs(grain: DataFrame, windows=None, tasks: bool = False) -> DataFrame:
    """Merged partials per (part, user, merchant): what all three blocks are made of."""
    dealt = _dealt(grain, tasks, "user_id", "merchant_id")
    return _merged(in_windows(dealt, windows or A_WINDOWS), ["part", "user_id", "merchant_id"])


def a_user_merchant(grain: DataFrame, windows=None, tasks: bool = False) -> DataFrame:
    """A-5 of every window."""
    bt, rc = _nz(F.col("n_date")), _nz(F.col("n_coupon"))
    return a_pairs(grain, windows, tasks).select(
        "part", "user_id", "merchant_id", bt.alias("user_merchant_buy_total"), rc.alias("user_merchant_received"),
        F.col("n_both").alias("user_merchant_buy_use_coupon"), F.col("n").alias("user_merchant_any"),
        F.col("n_common").alias("user_merchant_buy_common"),
        RF.rate_null("n_both", rc).alias("user_merchant_coupon_transfer_rate"),
        RF.rate_null("n_both", bt).alias("user_merchant_coupon_buy_rate"),
        RF.rate_null(bt, F.col("n")).alias("user_merchant_rate"),
        RF.rate_null("n_common", bt).alias("user_merchant_common_buy_rate"))


def _distances(name: str) -> list:
    """Minimum, maximum, mean and exact median distance of used receipts.  The median is of
    counted values, so its buffer holds a group's distinct distances, which are few."""
    d, n = F.col("distance"), F.col("n_used")
    return [F.min(d).alias(f"{name}_min_distance"), F.max(d).alias(f"{name}_max_distance"),
            F.try_divide(F.sum(d * n), F.sum(F.when(d.isNotNull(), n))).alias(f"{name}_mean_distance"),
            F.percentile(d, 0.5, n).alias(f"{name}_median_distance")]


def a_merchant(grain: DataFrame, windows=None) -> DataFrame:
    """A-3 of every window."""
    g = _merged(in_windows(grain, windows or A_WINDOWS), ["part", "merchant_id"], *_distances("merchant"))
    sales, coupons = _nz(F.col("n_date")), _nz(F.col("n_coupon"))
    return g.select(
        "part", "merchant_id", sales.alias("total_sales"), F.col("n_used").alias("sales_use_coupon"),
        F.col("n_coupon").alias("total_coupon"), "merchant_min_distance", "merchant_max_distance",
        "merchant_mean_distance", "merchant_median_distance",
        RF.rate_null("n_used", coupons).alias("merchant_coupon_transfer_rate"),
        RF.rate_null("n_used", sales).alias("coupon_rate"))


def a_user(grain: DataFrame, windows=None) -> DataFrame:
    """A-4 of every window.  Distinct merchants are counted on their own, on (user, merchant)
    pairs, so that no pair carries a median's buffer."""
    tagged = in_windows(grain, windows or A_WINDOWS)
    g = _merged(tagged, ["part", "user_id"], *_distances("user"))
    merchants = (tagged.where("n_date > 0").select("part", "user_id", "merchant_id").distinct()
                 .groupBy("part", "user_id").agg(F.count(F.lit(1)).alias("count_merchant")))
    g = g.join(merchants, ["part", "user_id"], "left").na.fill(0, ["count_merchant"])
    return g.select(
        "part", "user_id", "count_merchant", "user_min_distance", "user_max_distance", "user_mean_distance",
        "user_median_distance", F.col("n_used").alias("buy_use_coupon"), F.col("n_date").alias("buy_total"),
        F.col("n_coupon").alias("coupon_received"),
        F.try_divide(F.col("gap_sum").cast("double"), F.col("n_both")).alias("avg_user_date_datereceived_gap"),
        F.col("gap_min").alias("min_user_date_datereceived_gap"), F.col("gap_max").alias("max_user_date_datereceived_gap"),
        RF.rate_null("n_used", _nz(F.col("n_date"))).alias("buy_use_coupon_rate"),
        RF.rate_null("n_used", _nz(F.col("n_coupon"))).alias("user_coupon_transfer_rate"))


# ---------------------------------------------------------------- Family B
def b_grain(prepared: DataFrame, files: int | None = None) -> DataFrame:
    """Partials per (user, merchant, coupon, minimum spend, receipt day) of prepared rows
    (``prep.prepare_b``)."""
    known = B.consumed() & (F.col("distance") != -1)
    rows = prepared.where(F.col("date_received").isNotNull()).withColumn("day", F.col("date_received"))
    return (_ranged(rows, files)
            .groupBy("user_id", "merchant_id", "coupon_id",
                     F.when(F.col("is_manjian") == 1, F.col("min_cost_of_manjian")).alias("min_cost"), "day")
            .agg(F.count(F.lit(1)).alias("n"), _count_if(B.consumed()).alias("n_used"),
                 _count_if(B.redeemed15()).alias("n_15"),
                 F.sum(F.when(B.redeemed15(), F.datediff("date", "date_received"))).alias("gap_15"),
                 F.sum(F.when(B.consumed(), F.col("discount_rate"))).alias("rate_sum"),
                 _count_if(B.consumed() & F.col("discount_rate").isNotNull()).alias("rate_n"),
                 F.sum(F.when(known, F.col("distance"))).alias("far_sum"), _count_if(known).alias("far_n")))


def _sums(*names) -> list:
    return [F.sum(c).alias(c) for c in names]


def b_history(grain: DataFrame, windows=None, tasks: bool = False) -> dict[str, DataFrame]:
    """Raw history aggregates of every window: ``user``, ``merchant``, ``coupon``, ``user_coupon``,
    each with ``part``, its keys and the columns of the block in ``blocks_b``.

    A user's three distinct counts of merchants are counts of the merged (user, merchant)
    rows, and so is a merchant's of users; a merchant's coupons are counted on merged
    (merchant, coupon) rows.
    """
    t = in_windows(grain, windows or B_WINDOWS)
    pu = RF.prefix("history_field", ["user_id"])
    pm = RF.prefix("history_field", ["merchant_id"])
    pc = RF.prefix("history_field", ["coupon_id"])
    puc = RF.prefix("history_field", ["user_id", "coupon_id"])
    dealt = in_windows(_dealt(grain, tasks, "user_id", "merchant_id"), windows or B_WINDOWS)
    pairs = dealt.groupBy("part", "user_id", "merchant_id").agg(*_sums("n", "n_used", "n_15", "rate_sum", "rate_n", "far_sum", "far_n"))
    user = pairs.groupBy("part", "user_id").agg(
        F.sum("n").alias(pu + "receive_cnt"), (F.sum("n") - F.sum("n_used")).alias(pu + "receive_not_consume_cnt"),
        F.sum("n_used").alias(pu + "receive_and_consume_cnt"),
        F.count("merchant_id").alias(pu + "receive_differ_Merchant_cnt"),
        F.count(F.when(F.col("n_15") > 0, F.col("merchant_id"))).alias(pu + "receive_and_consume_differ_Merchant_cnt_15"),
        F.try_divide(F.sum("rate_sum"), F.sum("rate_n")).alias(pu + "receive_and_consume_mean_discount_rate"),
        F.try_divide(F.sum("far_sum").cast("double"), F.sum("far_n")).alias(pu + "receive_and_consume_mean_distance"),
        F.count(F.when(F.col("n_used") > 0, F.col("merchant_id"))).alias(pu + "receive_differ_Merchant_and_consume_cnt"))
    none = F.lit(None).cast("long")
    offered = t.select("part", "merchant_id", "coupon_id").distinct()
    merchant = (pairs.select("part", "merchant_id", "n", "n_used", "user_id", none.alias("coupon"))
                .unionByName(offered.select("part", "merchant_id", none.alias("n"), none.alias("n_used"), none.alias("user_id"),
                                            F.col("coupon_id").alias("coupon")))
                .groupBy("part", "merchant_id").agg(
                    F.sum("n").alias(pm + "received_cnt"), F.count("user_id").alias(pm + "received_differ_User_cnt"),
                    F.sum("n_used").alias(pm + "received_and_consumed_cnt"),
                    (F.sum("n") - F.sum("n_used")).alias(pm + "received_not_consumed_cnt"),
                    F.count("coupon").alias(pm + "differ_Coupon_cnt")))
    coupon = t.groupBy("part", "coupon_id").agg(
        F.sum("n").alias(pc + "received_cnt"), F.sum("n_15").alias(pc + "received_and_consumed_cnt_15"),
        F.try_divide(F.sum("gap_15").cast("double"), F.sum("n_15")).alias(pc + "consumed_mean_time_gap_15"),
        # of counted values: the buffer holds a coupon's distinct minimum spends
        F.percentile("min_cost", 0.5, F.col("n")).alias(pc + "median_of_min_cost_of_manjian"))
    user_coupon = t.groupBy("part", "user_id", "coupon_id").agg(
        F.sum("n").alias(puc + "receive_cnt"), F.sum("n_used").alias(puc + "receive_and_consume_cnt"))
    return {"user": user, "merchant": merchant, "coupon": coupon, "user_coupon": user_coupon}


_BLOCKS = {"user": B.USER, "merchant": B.MERCHANT, "coupon": B.COUPON, "user_coupon": B.USER_COUPON, "user_ext": B.USER_EXT}


def hist(name: str, labels: DataFrame, grain: DataFrame, windows=None, tasks: bool = False) -> DataFrame:
    """B-3 .. B-7 (``name``: a key of ``_BLOCKS``) of every split: one row per distinct (part, key) of
    ``labels``, the label rows of all splits with their ``part``."""
    block = _BLOCKS[name]()
    cond = F.lit(True)
    for k in block.keys:
        cond = cond & F.col(k).isNotNull()
    keys = ["part", *block.keys]
    raw = b_history(grain, windows, tasks)["user" if name == "user_ext" else name]
    return labels.select(*keys).where(cond).distinct().join(raw, keys, "left").select(*keys, *block.finish_columns())
