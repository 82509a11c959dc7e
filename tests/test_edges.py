"""Hand-built edge rows (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from helpers import d, log_df
from redeemflow import functions as RF
from redeemflow.operators import blocks_a as A
from redeemflow.operators import blocks_b as B
from redeemflow.operators import prep
from redeemflow.operators.receipts import date_list_text, date_lists

OTHER_ROWS = [
    # single receipt
    (1, 1, 1, "0.95", 1, "05-20", None),
    # same-day double receipt
    (1, 1, 2, "0.95", 1, "05-20", None),
    (1, 1, 2, "0.95", 1, "05-20", None),
    # three receipts
    (1, 1, 3, "30:5", 1, "05-18", None),
    (1, 1, 3, "30:5", 1, "05-20", None),
    (1, 1, 3, "30:5", 1, "05-25", None),
    # month crossing
    (1, 1, 4, "30:5", 1, "05-31", None),
    (1, 1, 4, "30:5", 1, "06-02", None),
]


def _other(spark):
    rows = A.other_features(log_df(spark, OTHER_ROWS)).collect()
    return {(r.coupon_id, r.date_received): r for r in rows}


def test_first_last_and_gaps(spark):
    o = _other(spark)
    single = o[(1, d("05-20"))]
    assert (single.this_month_user_receive_same_coupon_lastone,
            single.this_month_user_receive_same_coupon_firstone) == (-1, -1)
    assert (single.day_gap_before, single.day_gap_after) == (-1, -1)

    double = o[(2, d("05-20"))]
    assert (double.this_month_user_receive_same_coupon_lastone,
            double.this_month_user_receive_same_coupon_firstone) == (1, 1)
    assert (double.day_gap_before, double.day_gap_after) == (-1, -1)
    assert double.this_day_user_receive_same_coupon_count == 2

    middle = o[(3, d("05-20"))]
    assert (middle.this_month_user_receive_same_coupon_lastone,
            middle.this_month_user_receive_same_coupon_firstone) == (0, 0)
    assert (middle.day_gap_before, middle.day_gap_after) == (2, 5)

    assert o[(4, d("05-31"))].day_gap_after == 2
    assert o[(4, d("06-02"))].day_gap_before == 2

    # user totals: 8 receipts, 3 on 05-20
    assert middle.this_month_user_receive_all_coupon_count == 8
    assert middle.this_day_user_receive_all_coupon_count == 4


def test_repeat_flag(spark):
    rows = prep.prepare_b(log_df(spark, OTHER_ROWS))
    out = {(r.coupon_id, r.date_received): r for r in B.simple_features(rows).collect()}
    assert out[(2, d("05-20"))].simple_User_id_Coupon_id_Date_received_repeat_receive == 1
    assert out[(1, d("05-20"))].simple_User_id_Coupon_id_Date_received_repeat_receive == 0
    assert out[(3, d("05-20"))].simple_User_id_Coupon_id_receive_cnt == 3


def test_labels(spark):
    rows = [
        (1, 1, 1, "0.95", 1, "05-01", "05-16"),  # gap 15
        (1, 1, 1, "0.95", 1, "05-01", "05-17"),  # gap 16
        (1, 1, 1, "0.95", 1, "05-01", None),     # never
        (1, 1, 1, "0.95", 1, "05-10", "05-07"),  # consumed before received
        (1, 1, None, None, 1, None, "05-07"),    # purchase without coupon
    ]
    df = log_df(spark, rows).select(RF.label_binary().alias("b"), RF.label_threeway().alias("t"))
    got = [(r.b, r.t) for r in df.collect()]
    assert got == [(1, 1), (0, -1), (0, 0), (1, 1), (0, 0)]


def test_merchant_null_rules(spark):
    rows = [
        # merchant 1: only unredeemed receipts
        (1, 1, 1, "0.95", 1, "03-01", None),
        # merchant 2: only plain purchases
        (1, 2, None, None, 2, None, "03-02"),
    ]
    out = {r.merchant_id: r for r in A.merchant_features(log_df(spark, rows)).collect()}
    m1, m2 = out[1], out[2]
    assert m1.total_sales is None and m1.sales_use_coupon == 0
    assert m1.merchant_coupon_transfer_rate == 0.0 and m1.coupon_rate is None
    assert m2.total_coupon == 0 and m2.merchant_coupon_transfer_rate is None
    assert m2.coupon_rate == 0.0


def test_user_merchant_nulls_and_common_buys(spark):
    rows = [
        (1, 1, None, None, 2, None, "03-02"),          # plain purchase
        (1, 1, 5, "30:5", 2, "03-01", None),            # unredeemed receipt
        (2, 1, 5, "30:5", 2, "03-01", None),            # user 2: receipt only
    ]
    out = {(r.user_id, r.merchant_id): r
           for r in A.user_merchant_features(log_df(spark, rows)).collect()}
    assert out[(1, 1)].user_merchant_buy_common == 1
    assert out[(1, 1)].user_merchant_buy_total == 1
    assert out[(2, 1)].user_merchant_buy_total is None
    assert out[(2, 1)].user_merchant_rate is None


def test_history_unseen_user_and_coupon(spark):
    label = prep.prepare_b(log_df(spark, [(9, 1, 7, "0.95", 1, "05-20", None)]))
    history = prep.prepare_b(log_df(spark, [(1, 1, 8, "0.95", 1, "04-01", "04-02")]))
    u = B.hist_user(label, history).collect()[0]
    assert u.history_field_User_id_receive_cnt == 0
    assert u.history_field_User_id_receive_and_consume_rate == 0.0
    c = B.hist_coupon(label, history).collect()[0]
    assert c.history_field_Coupon_id_consumed_mean_time_gap_15 == -1.0
    assert c.history_field_Coupon_id_median_of_min_cost_of_manjian == 0.0


def test_discount_parsing(spark):
    df = log_df(spark, [(1, 1, 1, "0.95", 1, "05-01", None),
                        (1, 1, 1, "30:5", 1, "05-01", None),
                        (1, 1, 1, None, 1, "05-01", None),
                        (1, 1, 1, "junk", 1, "05-01", None)])
    out = prep.with_discount(df).select(
        F.round("discount_ratio", 6).alias("r"), "is_manjian", "min_cost_of_manjian").collect()
    assert [tuple(r) for r in out] == [(0.95, 0, -1), (0.833333, 1, 30), (None, 0, -1),
                                       (None, 0, -1)]


def test_date_list_keeps_repeats_sorted(spark):
    rows = [(1, 1, 3, "30:5", 1, "05-25", None), (1, 1, 3, "30:5", 1, "05-18", None),
            (1, 1, 3, "30:5", 1, "05-18", None)]
    out = date_list_text(date_lists(log_df(spark, rows))).collect()[0]
    assert out.dates == "20160518:2,20160525:1"


def test_approx_distinct_option_close_to_exact(spark):
    import random

    random.seed(11)
    rows = [(u, random.randint(1, 400), 1, "0.95", 1, "04-01", None)
            for u in (1, 2) for _ in range(3000)]
    label = prep.prepare_b(log_df(spark, [(1, 1, 1, "0.95", 1, "05-20", None),
                                          (2, 1, 1, "0.95", 1, "05-20", None)]))
    history = prep.prepare_b(log_df(spark, rows))
    col = "history_field_User_id_receive_differ_Merchant_cnt"
    exact = {r.user_id: r[col] for r in B.hist_user(label, history).collect()}
    approx = {r.user_id: r[col] for r in B.hist_user(label, history, approx=True).collect()}
    for u in (1, 2):
        assert abs(approx[u] - exact[u]) <= 0.1 * exact[u]
