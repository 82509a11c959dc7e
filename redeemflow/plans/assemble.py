"""Dataset assembly: feature blocks joined onto the rows they describe.

Family B (B-8): the label-interval rows get the simple, week and history
blocks; ids, raw text and dates are dropped; the projected rows are
deduplicated.  Family A (A-6): the dataset rows get coupon, merchant, user,
user-merchant and other blocks, are deduplicated BEFORE the drop (as the
reference does), then labelled.

Join layout: the per-(user, coupon, day) statistics table is the only
table joined to the rows on a composite key; user, coupon and user-coupon
features are attached to that (smaller) table first, so the rows are shuffled
once for all key-derived features.  The merchant block, one row per merchant,
is joined last: AQE turns that join into a broadcast before the rows move when
its measured size is below the broadcast threshold, and keeps a sort-merge
join (with skew splitting) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF
from redeemflow.operators import blocks_a as A
from redeemflow.operators import blocks_b as B
from redeemflow.operators.daygrain import (B_WINDOWS, a_grain, a_merchant, a_user, a_user_merchant, b_grain, b_history,
                                           in_windows)
from redeemflow.operators.prep import ISO_WEEKDAY_DOMAIN, prepare_b
from redeemflow.operators.receipts import receipt_day_stats
from redeemflow.operators.split import A_SETS, B_SPLITS, _plus

UCD = ["user_id", "coupon_id", "date_received"]

# Family B: the columns kept for every assembled set (label appended last).
B_BASE = ["user_id", "coupon_id", "distance", "date_received", "is_manjian", "discount_rate",
          "min_cost_of_manjian", "null_distance"]
B_ID_COLUMNS = ["user_id", "coupon_id", "date_received"]


def b_labels(log: DataFrame, names: list[str], test_log: DataFrame | None = None) -> DataFrame:
    """Prepared label rows of several splits, each with its ``part``.  The log is read
    once for the splits it labels; ``test`` takes the test table, without a label."""
    own = {n: B_SPLITS[n].label for n in names if B_SPLITS[n].label is not None}
    rows = None
    if own:
        days = {n: (first, _plus(first, length - 1)) for n, (first, length) in own.items()}
        rows = in_windows(prepare_b(log), days, "date_received")
    if len(own) < len(names):
        if test_log is None:
            raise ValueError("the test split labels the test table; pass test_log")
        test = prepare_b(test_log).select(F.lit("test").alias("part"), "*")
        rows = test if rows is None else rows.unionByName(test, allowMissingColumns=True)
    return rows


def b_sets(log: DataFrame, names: list[str], test_log: DataFrame | None = None, with_history: bool = True,
           grain: DataFrame | None = None) -> DataFrame:
    """B-8 of several splits at once, told apart by ``part``.

    History comes from day-grain partials (``daygrain.b_grain`` of the log; pass the
    stored table as ``grain``), which are rolled up once for all splits.  Every
    aggregate but the merchant's is keyed by a part of the (user, coupon, day) key and
    goes onto that table, so the rows meet them in one join; the merchant's (one row
    per merchant) comes last, where its measured size lets AQE broadcast it.  Keys
    without history get the blocks' fill values in the final projection.
    """
    label = b_labels(log, names, test_log)
    stats = receipt_day_stats(label, by=("part",)).select(
        "part", *UCD, *[F.col(c).alias(n) for c, n in zip(("n_u", "n_uc", "n_ud", "n_ucd"), B.SIMPLE_COLUMNS)],
        (F.col("n_ucd") > 1).cast("int").alias(B.SIMPLE_COLUMNS[4]))
    blocks = []
    if with_history:
        h = b_history(b_grain(prepare_b(log)) if grain is None else grain, {n: B_WINDOWS[n] for n in names},
                      tasks=grain is not None)
        blocks = [B.USER(), B.MERCHANT(), B.COUPON(), B.USER_COUPON()]
        stats = (stats.join(h["coupon"], ["part", "coupon_id"], "left").join(h["user"], ["part", "user_id"], "left")
                 .join(h["user_coupon"], ["part", "user_id", "coupon_id"], "left"))
    rows = label.join(stats, ["part", *UCD], "left")
    if with_history:
        rows = rows.join(h["merchant"], ["part", "merchant_id"], "left")
    hist_cols = [c for blk in blocks for c in blk.order]
    finish = [c for blk in blocks for c in blk.finish_columns()]
    rows = B.week_features(rows.select(*[c for c in rows.columns if c not in set(hist_cols)], *finish))
    tail = ["label"] if "label" in label.columns else []
    return rows.select("part", *B_BASE, *B.WEEK_COLUMNS, *B.SIMPLE_COLUMNS, *hist_cols, *tail).distinct()


def b_dataset(log: DataFrame, split: str, test_log: DataFrame | None = None,
              with_history: bool = True, grain: DataFrame | None = None) -> DataFrame:
    """Prepare, split and assemble one Family B set (train / validate / test)."""
    return b_sets(log, [split], test_log, with_history, grain).drop("part")


def b_big_train(log: DataFrame, with_history: bool = True, grain: DataFrame | None = None) -> DataFrame:
    """Train and validate sets stacked (the final-fit input), in one plan."""
    return b_sets(log, ["train", "validate"], None, with_history, grain).drop("part")


# ---------------------------------------------------------------- Family A
A_FILL_ZERO = ["user_merchant_buy_total", "user_merchant_any", "user_merchant_received"]
A_DROP = ["merchant_id", "day_of_week"]
A_DROP_TRAIN = ["date", "date_received", "coupon_id"]


def a_sets(log: DataFrame, numbers: list[int], test_log: DataFrame | None = None,
           grain: DataFrame | None = None) -> DataFrame:
    """A-6 for several sets at once (1, 2: labelled train sets; 3: the test table, alone),
    told apart by ``part`` (``set1`` ...).  Feature blocks come from day-grain partials
    (``daygrain.a_grain`` of the log; pass the stored table as ``grain``)."""
    sets = {f"set{n}": A_SETS[n] for n in numbers}
    if 3 in numbers:
        if len(numbers) > 1 or test_log is None:
            raise ValueError("set 3 is the test table, without a label: pass test_log, and no other set")
        data = test_log.select(F.lit("set3").alias("part"), "*")
    else:
        data = in_windows(log, {p: s.data for p, s in sets.items()}, "date_received")
    anchor = F.coalesce(*[F.when(F.col("part") == p, RF.lit_date(s.anchor)) for p, s in sets.items()])
    # The feature blocks are functions of the row's own keys, so deduplicating
    # the dataset first gives the same rows as the reference's dedupe after
    # the joins, with fewer rows to shuffle.  It happens after parsing: two
    # discount texts of one rate ("0.9", "0.90") are equal rows only then.
    # (coupon_count would be dropped below, so it is not joined in at all)
    rows = A.coupon_features(data, anchor, popularity=False).distinct()
    windows = {p: s.features for p, s in sets.items()}
    stored = grain is not None
    grain = grain if stored else a_grain(log)
    # user features ride on the (user, coupon, day) table, which is smaller
    # than the rows, so the rows take both in one join
    per_receipt = A.other_features(data, by=("part",)).join(a_user(grain, windows), ["part", "user_id"], "left")
    joined = (rows
              .join(per_receipt, ["part", *UCD], "left")
              .join(a_user_merchant(grain, windows, tasks=stored), ["part", "user_id", "merchant_id"], "left")
              .join(a_merchant(grain, windows), ["part", "merchant_id"], "left"))
    m_cols = ["total_sales", "sales_use_coupon", "total_coupon", "merchant_min_distance",
              "merchant_max_distance", "merchant_mean_distance", "merchant_median_distance",
              "merchant_coupon_transfer_rate", "coupon_rate"]
    u_cols = ["count_merchant", "user_min_distance", "user_max_distance", "user_mean_distance",
              "user_median_distance", "buy_use_coupon", "buy_total", "coupon_received",
              "avg_user_date_datereceived_gap", "min_user_date_datereceived_gap",
              "max_user_date_datereceived_gap", "buy_use_coupon_rate", "user_coupon_transfer_rate"]
    um_cols = ["user_merchant_buy_total", "user_merchant_received", "user_merchant_buy_use_coupon",
               "user_merchant_any", "user_merchant_buy_common",
               "user_merchant_coupon_transfer_rate", "user_merchant_coupon_buy_rate",
               "user_merchant_rate", "user_merchant_common_buy_rate"]
    labelled = "date" in data.columns
    drop = set(A_DROP) | (set(A_DROP_TRAIN) if labelled else set())
    out = [c for c in rows.columns if c not in drop]  # part first
    out += m_cols + u_cols + um_cols + A.OTHER_COLUMNS
    exprs = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in A_FILL_ZERO else F.col(c) for c in out]
    exprs.append(RF.is_weekend("date_received").alias("is_weekend"))
    exprs += RF.one_hot(RF.iso_weekday("date_received"), ISO_WEEKDAY_DOMAIN, lambda s: f"weekday{s}")
    if labelled:
        exprs.append(RF.label_threeway().alias("label"))
    return joined.select(*exprs)


def a_dataset(log: DataFrame, n: int, test_log: DataFrame | None = None, grain: DataFrame | None = None) -> DataFrame:
    """A-6 for set ``n`` (1, 2: labelled train sets; 3: the test table)."""
    return a_sets(log, [n], test_log, grain).drop("part")
