"""Family B feature blocks (baseline + chapter scripts).

Null rule of this family: counts of an absent key are 0, a rate with a 0
denominator is 0, a missing mean gap is -1, a missing median 0.

Each history block is ONE ``groupBy`` with conditional aggregates over the
history interval, left-joined to the distinct keys of the label interval.
Distinct counts plan as a two-level aggregate (first on key + value), so a
heavy key is split across tasks before its final count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF
from redeemflow.operators.prep import WEEKDAY0_DOMAIN
from redeemflow.operators.receipts import receipt_day_stats


def consumed() -> F.Column:
    return F.col("date").isNotNull()


def not_consumed() -> F.Column:
    return F.col("date").isNull()


def redeemed15() -> F.Column:
    return F.col("label") == 1


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _distinct(col, approx: bool) -> F.Column:
    """Exact distinct count (two-level aggregate), or HyperLogLog++
    (``approx_count_distinct``, one map-side-combined pass, ~5% relative
    error by default) when ``approx``; the reference counts exactly."""
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


# ----------------------------------------------------------------- B-1, B-2
def simple_features(label: DataFrame) -> DataFrame:
    """B-1: label rows plus receipt counts by user, (user, coupon),
    (user, day), (user, coupon, day) and the same-day repeat flag."""
    stats = receipt_day_stats(label).select(
        "user_id", "coupon_id", "date_received",
        F.col("n_u").alias(RF.prefix("simple", ["user_id"]) + "receive_cnt"),
        F.col("n_uc").alias(RF.prefix("simple", ["user_id", "coupon_id"]) + "receive_cnt"),
        F.col("n_ud").alias(RF.prefix("simple", ["user_id", "date_received"]) + "receive_cnt"),
        F.col("n_ucd").alias(RF.prefix("simple", ["user_id", "coupon_id", "date_received"])
                             + "receive_cnt"),
        (F.col("n_ucd") > 1).cast("int").alias(
            RF.prefix("simple", ["user_id", "coupon_id", "date_received"]) + "repeat_receive"),
    )
    return label.join(stats, ["user_id", "coupon_id", "date_received"], "left")


SIMPLE_COLUMNS = [
    "simple_User_id_receive_cnt",
    "simple_User_id_Coupon_id_receive_cnt",
    "simple_User_id_Date_received_receive_cnt",
    "simple_User_id_Coupon_id_Date_received_receive_cnt",
    "simple_User_id_Coupon_id_Date_received_repeat_receive",
]

WEEK_COLUMNS = ["week", "is_weekend"] + [f"week_{i}" for i in WEEKDAY0_DOMAIN]


def week_features(label: DataFrame) -> DataFrame:
    """B-2: weekday 0..6 of receipt, weekend flag, fixed one-hot week_0..6."""
    wk = RF.weekday0("date_received")
    return label.select("*", wk.alias("week"), RF.is_weekend("date_received").alias("is_weekend"),
                        *RF.one_hot(wk, WEEKDAY0_DOMAIN, lambda s: f"week_{s}"))


# ----------------------------------------------------------------- B-3 .. B-7
# A history block = keys + one aggregate over the history interval +
# a "finish" projection (zero fill, then rates).  Keeping the two apart
# lets assembly join the raw aggregate straight onto a table that already
# holds the label keys, without building a separate key spine.
class HistBlock:
    def __init__(self, keys, aggs, fill, rates, order):
        self.keys = keys          # grouping keys
        self.aggs = aggs          # () -> list of aliased aggregate columns
        self.fill = fill          # column -> value for keys absent from history
        self.rates = rates        # column -> (numerator, denominator), zero rule
        self.order = order        # output feature columns in order

    def aggregate(self, history: DataFrame) -> DataFrame:
        return history.groupBy(*self.keys).agg(*self.aggs())

    def finish_columns(self) -> list[F.Column]:
        filled = {n: F.coalesce(F.col(n), F.lit(v)) for n, v in self.fill.items()}
        out = []
        for n in self.order:
            if n in self.rates:
                num, den = self.rates[n]
                out.append(RF.rate_zero(filled[num], filled[den]).alias(n))
            else:
                out.append(filled[n].alias(n))
        return out

    def for_label(self, label: DataFrame, history: DataFrame) -> DataFrame:
        """One row per distinct label-interval key."""
        cond = None
        for k in self.keys:
            cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
        spine = label.select(*self.keys).where(cond).distinct()
        joined = spine.join(self.aggregate(history), self.keys, "left")
        return joined.select(*self.keys, *self.finish_columns())


def _user_block(approx: bool = False) -> HistBlock:
    p = RF.prefix("history_field", ["user_id"])
    return HistBlock(
        ["user_id"],
        lambda: [
            F.count(F.lit(1)).alias(p + "receive_cnt"),
            _count_if(not_consumed()).alias(p + "receive_not_consume_cnt"),
            _count_if(consumed()).alias(p + "receive_and_consume_cnt"),
            _distinct(F.col("merchant_id"), approx).alias(p + "receive_differ_Merchant_cnt"),
            _distinct(F.when(redeemed15(), F.col("merchant_id")), approx)
             .alias(p + "receive_and_consume_differ_Merchant_cnt_15")],
        {p + "receive_cnt": 0, p + "receive_not_consume_cnt": 0, p + "receive_and_consume_cnt": 0,
         p + "receive_differ_Merchant_cnt": 0, p + "receive_and_consume_differ_Merchant_cnt_15": 0},
        {p + "receive_and_consume_rate": (p + "receive_and_consume_cnt", p + "receive_cnt")},
        [p + "receive_cnt", p + "receive_not_consume_cnt", p + "receive_and_consume_cnt",
         p + "receive_and_consume_rate", p + "receive_differ_Merchant_cnt",
         p + "receive_and_consume_differ_Merchant_cnt_15"])


def _merchant_block(approx: bool = False) -> HistBlock:
    p = RF.prefix("history_field", ["merchant_id"])
    return HistBlock(
        ["merchant_id"],
        lambda: [
            F.count(F.lit(1)).alias(p + "received_cnt"),
            _distinct(F.col("user_id"), approx).alias(p + "received_differ_User_cnt"),
            _count_if(consumed()).alias(p + "received_and_consumed_cnt"),
            _count_if(not_consumed()).alias(p + "received_not_consumed_cnt"),
            _distinct(F.col("coupon_id"), approx).alias(p + "differ_Coupon_cnt")],
        {p + "received_cnt": 0, p + "received_differ_User_cnt": 0,
         p + "received_and_consumed_cnt": 0, p + "received_not_consumed_cnt": 0,
         p + "differ_Coupon_cnt": 0},
        {p + "received_and_consumed_rate": (p + "received_and_consumed_cnt", p + "received_cnt")},
        [p + "received_cnt", p + "received_differ_User_cnt", p + "received_and_consumed_cnt",
         p + "received_and_consumed_rate", p + "received_not_consumed_cnt", p + "differ_Coupon_cnt"])


def _coupon_block() -> HistBlock:
    p = RF.prefix("history_field", ["coupon_id"])
    return HistBlock(
        ["coupon_id"],
        lambda: [
            F.count(F.lit(1)).alias(p + "received_cnt"),
            _count_if(redeemed15()).alias(p + "received_and_consumed_cnt_15"),
            F.avg(F.when(redeemed15(), F.datediff("date", "date_received")).cast("double"))
             .alias(p + "consumed_mean_time_gap_15"),
            F.median(F.when(F.col("is_manjian") == 1, F.col("min_cost_of_manjian")))
             .alias(p + "median_of_min_cost_of_manjian")],
        {p + "received_cnt": 0, p + "received_and_consumed_cnt_15": 0,
         p + "consumed_mean_time_gap_15": -1.0, p + "median_of_min_cost_of_manjian": 0.0},
        {p + "received_and_consumed_rate_15": (p + "received_and_consumed_cnt_15", p + "received_cnt")},
        [p + "received_cnt", p + "received_and_consumed_cnt_15", p + "received_and_consumed_rate_15",
         p + "consumed_mean_time_gap_15", p + "median_of_min_cost_of_manjian"])


def _user_coupon_block() -> HistBlock:
    keys = ["user_id", "coupon_id"]
    p = RF.prefix("history_field", keys)
    return HistBlock(
        keys,
        lambda: [F.count(F.lit(1)).alias(p + "receive_cnt"),
                 _count_if(consumed()).alias(p + "receive_and_consume_cnt")],
        {p + "receive_cnt": 0, p + "receive_and_consume_cnt": 0},
        {p + "receive_and_consume_rate": (p + "receive_and_consume_cnt", p + "receive_cnt")},
        [p + "receive_cnt", p + "receive_and_consume_cnt", p + "receive_and_consume_rate"])


def _user_ext_block(approx: bool = False) -> HistBlock:
    p = RF.prefix("history_field", ["user_id"])
    return HistBlock(
        ["user_id"],
        lambda: [
            F.count(F.lit(1)).alias(p + "receive_cnt"),
            _count_if(not_consumed()).alias(p + "receive_not_consume_cnt"),
            _count_if(consumed()).alias(p + "receive_and_consume_cnt"),
            F.avg(F.when(consumed(), F.col("discount_rate")))
             .alias(p + "receive_and_consume_mean_discount_rate"),
            F.avg(F.when(consumed() & (F.col("distance") != -1), F.col("distance")).cast("double"))
             .alias(p + "receive_and_consume_mean_distance"),
            _distinct(F.when(consumed(), F.col("merchant_id")), approx)
             .alias(p + "receive_differ_Merchant_and_consume_cnt"),
            _distinct(F.col("merchant_id"), approx).alias(p + "receive_differ_Merchant_cnt")],
        {p + "receive_cnt": 0, p + "receive_not_consume_cnt": 0, p + "receive_and_consume_cnt": 0,
         p + "receive_and_consume_mean_discount_rate": 0.0,
         p + "receive_and_consume_mean_distance": 0.0,
         p + "receive_differ_Merchant_and_consume_cnt": 0, p + "receive_differ_Merchant_cnt": 0},
        {p + "receive_and_consume_rate": (p + "receive_and_consume_cnt", p + "receive_cnt"),
         p + "receive_differ_Merchant_consume_rate": (p + "receive_differ_Merchant_and_consume_cnt",
                                                      p + "receive_differ_Merchant_cnt")},
        [p + "receive_cnt", p + "receive_not_consume_cnt", p + "receive_and_consume_cnt",
         p + "receive_and_consume_rate", p + "receive_and_consume_mean_discount_rate",
         p + "receive_and_consume_mean_distance", p + "receive_differ_Merchant_and_consume_cnt",
         p + "receive_differ_Merchant_cnt", p + "receive_differ_Merchant_consume_rate"])


USER, MERCHANT, COUPON, USER_COUPON, USER_EXT = (
    _user_block, _merchant_block, _coupon_block, _user_coupon_block, _user_ext_block)


def hist_user(label: DataFrame, history: DataFrame, approx: bool = False) -> DataFrame:
    """B-3: per label-interval user, history receipt behaviour."""
    return USER(approx).for_label(label, history)


def hist_merchant(label: DataFrame, history: DataFrame, approx: bool = False) -> DataFrame:
    """B-4: per label-interval merchant."""
    return MERCHANT(approx).for_label(label, history)


def hist_coupon(label: DataFrame, history: DataFrame) -> DataFrame:
    """B-5: per label-interval coupon; mean gap of 15-day redemptions
    (missing -1) and median minimum spend of X:Y receipts (missing 0)."""
    return COUPON().for_label(label, history)


def hist_user_coupon(label: DataFrame, history: DataFrame) -> DataFrame:
    """B-6, plus the documented-but-missing rate (zero rule)."""
    return USER_COUPON().for_label(label, history)


def hist_user_ext(label: DataFrame, history: DataFrame, approx: bool = False) -> DataFrame:
    """B-7: B-3's counts plus mean discount and distance of used receipts
    and the merchant-level redemption share.  The consumed count uses
    ``date`` present (the exercise script repeated the not-consumed count)."""
    return USER_EXT(approx).for_label(label, history)
