
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from redeemflow.operators import eda
from redeemflow.sources import coupon_log


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda name: qs[name](spark, SF_SMALL)


def test_daily_resums_to_weekday(q):
    daily = q("eda_daily").select(F.weekday("date_received").alias("w"), "received")
    by_w = {r.w + 1: r.s for r in daily.groupBy("w").agg(F.sum("received").alias("s")).collect()}
    weekday = {r.weekday: r.received for r in q("eda_weekday").collect()}
    assert by_w == weekday


def test_received_equals_redeemed_plus_not(spark):
    lg = coupon_log(spark, SF_SMALL)
    r = eda.profile(lg).collect()[0]
    lab = lg.where(F.col("date_received").isNotNull())
    assert lab.count() == r.receipts


def test_shares_sum_to_one(q):
    for name in ("eda_type_share", "eda_type_share_redeemed", "eda_label_share"):
        total = sum(r.share for r in q(name).collect())
        assert abs(total - 1.0) < 1e-5


def test_blocks_have_one_row_per_key(q):
    for name, keys in (("feat_hist_user", ["user_id"]), ("feat_hist_merchant", ["merchant_id"]),
                       ("feat_hist_coupon", ["coupon_id"]),
                       ("feat_hist_user_coupon", ["user_id", "coupon_id"]),
                       ("a_user", ["user_id"]), ("a_merchant", ["merchant_id"]),
                       ("a_user_merchant", ["user_id", "merchant_id"]),
                       ("a_other", ["user_id", "coupon_id", "date_received"])):
        df = q(name)
        assert df.count() == df.select(*keys).distinct().count(), name


def test_assembled_rows_are_distinct(q):
    df = q("ds_assemble")
    assert df.count() == df.distinct().count()


def test_big_train_is_train_plus_validate(q):
    assert q("ds_big_train").count() >= q("ds_assemble").count()


def test_month_counts_cover_all_receipts_and_purchases(spark, q):
    lg = coupon_log(spark, SF_SMALL)
    m = q("eda_month").agg(F.sum("received").alias("r"), F.sum("consumed").alias("c")).collect()[0]
    assert m.r == lg.where(F.col("date_received").isNotNull()).count()
    assert m.c == lg.where(F.col("date").isNotNull()).count()


def test_splits_are_all_nonempty(q):
    b = {r.split: r.rows for r in q("split_b").collect()}
    assert set(b) == {f"{s}_{p}" for s in ("train", "validate", "test")
                      for p in ("history", "middle", "label")}
    a = {r.split for r in q("split_a").collect()}
    assert a == {f"set{n}_{p}" for n in (1, 2, 3) for p in ("dataset", "features")}
