"""Family A feature blocks (feature-extraction script).

Null rule of this family: a block is left-joined to the distinct keys of
its window, so an absent count is null; some counts are zero-filled, and
always AFTER the ratios are taken, so a rate over an absent denominator
stays null.  Each block is one ``groupBy`` with conditional aggregates
(one shuffle, map-side partial aggregation), not one group-by per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF
from redeemflow.operators.receipts import day_gaps, first_last_flags, receipt_day_stats

def has_date() -> F.Column:
    return F.col("date").isNotNull()


def has_coupon() -> F.Column:
    return F.col("coupon_id").isNotNull()


def has_received() -> F.Column:
    return F.col("date_received").isNotNull()


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _nz(col) -> F.Column:
    """count -> null when 0 (the key had no such rows in the reference)."""
    return F.when(col > 0, col)


# ----------------------------------------------------------------- A-1
OTHER_COLUMNS = [
    "this_month_user_receive_same_coupon_count",
    "this_month_user_receive_all_coupon_count",
    "this_month_user_receive_same_coupon_lastone",
    "this_month_user_receive_same_coupon_firstone",
    "this_day_user_receive_all_coupon_count",
    "this_day_user_receive_same_coupon_count",
    "day_gap_before",
    "day_gap_after",
]


def other_features(dataset: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A-1: one row per distinct (user, coupon, date_received) of the dataset (of each
    of its sets, told apart by ``by``)."""
    s = day_gaps(first_last_flags(receipt_day_stats(dataset, by=by)))
    return s.select(
        *by, "user_id", "coupon_id", "date_received",
        F.col("n_uc").alias("this_month_user_receive_same_coupon_count"),
        F.col("n_u").alias("this_month_user_receive_all_coupon_count"),
        "this_month_user_receive_same_coupon_lastone",
        "this_month_user_receive_same_coupon_firstone",
        F.col("n_ud").alias("this_day_user_receive_all_coupon_count"),
        F.col("n_ucd").alias("this_day_user_receive_same_coupon_count"),
        "day_gap_before", "day_gap_after",
    )


# ----------------------------------------------------------------- A-2
#: coupons (16 bytes each) whose counts may be broadcast
MAX_BROADCAST_COUPONS = 1_000_000
COUPON_COLUMNS = ["day_of_week", "day_of_month", "days_distance", "discount_man",
                  "discount_jian", "is_man_jian"]


def coupon_features(dataset: DataFrame, anchor: str | F.Column, popularity: bool = True) -> DataFrame:
    """A-2: dataset rows with receipt-date and discount features and the
    coupon's popularity in the dataset (``coupon_count``, unless ``popularity`` is
    false).

    ``discount_rate`` is replaced by its ratio (1 - Y/X form).  The
    popularity is a ``groupBy(coupon)`` joined back; a window over the coupon
    alone would put a popular coupon's rows into a single task.  Its rows are
    counted first: a small table is broadcast, so the rows do not move; a
    large one meets them in a sort-merge join (with skew splitting).
    """
    rows = dataset.select("*", *RF.discount_parts("discount_rate")).select(
        *[RF.p_ratio("discount_rate", "a").alias("discount_rate")
          if c == "discount_rate" else F.col(c) for c in dataset.columns],
        RF.iso_weekday("date_received").alias("day_of_week"),
        F.dayofmonth("date_received").alias("day_of_month"),
        F.datediff(F.col("date_received"), RF.lit_date(anchor) if isinstance(anchor, str) else anchor).alias("days_distance"),
        RF.p_man().alias("discount_man"),
        RF.p_jian().alias("discount_jian"),
        RF.p_is_manjian().alias("is_man_jian"),
    )
    if not popularity:
        return rows
    counts = (dataset.where(has_coupon()).groupBy("coupon_id")
              .agg(F.count(F.lit(1)).alias("coupon_count")))
    if counts.count() <= MAX_BROADCAST_COUPONS:
        counts = F.broadcast(counts)
    return rows.join(counts, "coupon_id", "left").select(*rows.columns, "coupon_count")


# ----------------------------------------------------------------- A-3
def merchant_features(features: DataFrame) -> DataFrame:
    """A-3: per merchant of the feature window."""
    used = has_date() & has_coupon()
    g = features.groupBy("merchant_id").agg(
        _count_if(has_date()).alias("total_sales"),
        _count_if(used).alias("sales_use_coupon"),
        _count_if(has_coupon()).alias("total_coupon"),
        F.min(F.when(used, F.col("distance"))).alias("merchant_min_distance"),
        F.max(F.when(used, F.col("distance"))).alias("merchant_max_distance"),
        F.avg(F.when(used, F.col("distance"))).alias("merchant_mean_distance"),
        F.median(F.when(used, F.col("distance"))).alias("merchant_median_distance"),
    )
    total_sales = _nz(F.col("total_sales"))
    total_coupon = _nz(F.col("total_coupon"))
    return g.select(
        "merchant_id",
        total_sales.alias("total_sales"),
        "sales_use_coupon",
        F.col("total_coupon"),
        "merchant_min_distance", "merchant_max_distance", "merchant_mean_distance",
        "merchant_median_distance",
        RF.rate_null("sales_use_coupon", total_coupon).alias("merchant_coupon_transfer_rate"),
        RF.rate_null("sales_use_coupon", total_sales).alias("coupon_rate"),
    )


# ----------------------------------------------------------------- A-4
def user_gap_features(features: DataFrame) -> DataFrame:
    """Part of A-4: days from receipt to use, per user (both dates present)."""
    gap = F.when(has_date() & has_received(), F.datediff("date", "date_received"))
    return features.groupBy("user_id").agg(
        F.avg(gap).alias("avg_user_date_datereceived_gap"),
        F.min(gap).alias("min_user_date_datereceived_gap"),
        F.max(gap).alias("max_user_date_datereceived_gap"),
    )


def user_features(features: DataFrame) -> DataFrame:
    """A-4: per user of the feature window.

    The distinct-merchant count is its own aggregate (dedupe on (user,
    merchant), then count) joined on ``user_id``: planned together with the
    median, Spark would carry a percentile buffer for every (user, merchant)
    pair of the distinct rewrite."""
    used = has_date() & has_coupon()
    gap = F.when(has_date() & has_received(), F.datediff("date", "date_received"))
    g = features.groupBy("user_id").agg(
        F.min(F.when(used, F.col("distance"))).alias("user_min_distance"),
        F.max(F.when(used, F.col("distance"))).alias("user_max_distance"),
        F.avg(F.when(used, F.col("distance"))).alias("user_mean_distance"),
        F.median(F.when(used, F.col("distance"))).alias("user_median_distance"),
        _count_if(used).alias("buy_use_coupon"),
        _count_if(has_date()).alias("buy_total"),
        _count_if(has_coupon()).alias("coupon_received"),
        F.avg(gap).alias("avg_user_date_datereceived_gap"),
        F.min(gap).alias("min_user_date_datereceived_gap"),
        F.max(gap).alias("max_user_date_datereceived_gap"),
    )
    merchants = (features.where(has_date()).select("user_id", "merchant_id").distinct()
                 .groupBy("user_id").agg(F.count(F.lit(1)).alias("count_merchant")))
    g = g.join(merchants, "user_id", "left")
    return g.select(
        "user_id", F.coalesce(F.col("count_merchant"), F.lit(0)).alias("count_merchant"),
        "user_min_distance", "user_max_distance", "user_mean_distance", "user_median_distance",
        "buy_use_coupon", "buy_total", "coupon_received",
        "avg_user_date_datereceived_gap", "min_user_date_datereceived_gap",
        "max_user_date_datereceived_gap",
        RF.rate_null("buy_use_coupon", _nz(F.col("buy_total"))).alias("buy_use_coupon_rate"),
        RF.rate_null("buy_use_coupon", _nz(F.col("coupon_received")))
        .alias("user_coupon_transfer_rate"),
    )


# ----------------------------------------------------------------- A-5
def user_merchant_features(features: DataFrame) -> DataFrame:
    """A-5: per (user, merchant) of the feature window.  Here buy_total and
    received stay null when absent (the dataset assembly fills them)."""
    g = features.groupBy("user_id", "merchant_id").agg(
        _count_if(has_date()).alias("bt"),
        _count_if(has_coupon()).alias("rc"),
        _count_if(has_date() & has_received()).alias("user_merchant_buy_use_coupon"),
        F.count(F.lit(1)).alias("user_merchant_any"),
        _count_if(has_date() & ~has_coupon()).alias("user_merchant_buy_common"),
    )
    bt, rc = _nz(F.col("bt")), _nz(F.col("rc"))
    return g.select(
        "user_id", "merchant_id",
        bt.alias("user_merchant_buy_total"),
        rc.alias("user_merchant_received"),
        "user_merchant_buy_use_coupon", "user_merchant_any", "user_merchant_buy_common",
        RF.rate_null("user_merchant_buy_use_coupon", rc).alias("user_merchant_coupon_transfer_rate"),
        RF.rate_null("user_merchant_buy_use_coupon", bt).alias("user_merchant_coupon_buy_rate"),
        RF.rate_null(bt, F.col("user_merchant_any")).alias("user_merchant_rate"),
        RF.rate_null("user_merchant_buy_common", bt).alias("user_merchant_common_buy_rate"),
    )
