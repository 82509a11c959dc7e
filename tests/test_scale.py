"""Scale properties: a key holding a third of all rows gives exact results,
and no query plans a window over a bare hot key."""

import random
import re
from collections import Counter

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from helpers import log_df
from redeemflow.operators import blocks_a as A
from redeemflow.operators.receipts import receipt_day_stats
from redeemflow.plans.queries import QUERIES


def test_hot_user_counts_are_exact(spark):
    random.seed(7)
    rows = []
    for i in range(300):
        u = 1 if i % 3 == 0 else random.randint(2, 40)   # user 1 holds a third
        c = random.randint(1, 6)
        day = random.randint(15, 31)
        rows.append((u, 1, c, "30:5", 1, f"05-{day:02d}", None))
    df = log_df(spark, rows)
    got = {(r.user_id, r.coupon_id, r.date_received.day): (r.n_u, r.n_uc, r.n_ud, r.n_ucd)
           for r in receipt_day_stats(df).collect()}
    keys = [(u, c, int(rec.split("-")[1])) for u, _, c, _, _, rec, _ in rows]
    n_u = Counter(k[0] for k in keys)
    n_uc = Counter(k[:2] for k in keys)
    n_ud = Counter((k[0], k[2]) for k in keys)
    n_ucd = Counter(keys)
    assert got == {k: (n_u[k[0]], n_uc[k[:2]], n_ud[(k[0], k[2])], n_ucd[k]) for k in n_ucd}
    assert got[next(k for k in got if k[0] == 1)][0] == 100
    assert A.other_features(df).count() == len(n_ucd)


WINDOW_KEYS_OK = ({"user_id", "coupon_id"},)


@pytest.mark.parametrize("name", ["feat_simple", "a_other", "ds_assemble", "a_dataset_train",
                                  "a_first_last", "a_day_gap"])
def test_windows_never_partition_by_a_bare_hot_key(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    specs = re.findall(r"windowspecdefinition\(([^)]*?)(?:,\s*\w+#\d+\s+ASC|,\s*specifiedwindowframe)", plan)
    assert specs, "expected the (user, coupon) window"
    for spec in specs:
        cols = {re.sub(r"#\d+L?$", "", c.strip()) for c in spec.split(",")}
        assert {"user_id", "coupon_id"} <= cols, spec


def test_hot_receipt_key_join_is_split_by_aqe(spark):
    """One (user, coupon, day) holds a third of all rows: with runtime
    broadcast off and low skew thresholds, AQE marks the join back to the
    rows as skewed (and splits it); the counts stay exact."""
    from pyspark.sql import functions as F

    from redeemflow.operators import blocks_b as B
    from redeemflow.operators import prep

    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        hot = F.col("id") % 3 == 0
        df = spark.range(n).select(
            F.when(hot, F.lit(1)).otherwise(F.col("id") % 900 + 2).cast("long").alias("user_id"),
            (F.col("id") % 25).alias("merchant_id"),
            F.when(hot, F.lit(0)).otherwise(F.col("id") % 50).cast("long").alias("coupon_id"),
            F.lit("30:5").alias("discount_rate"),
            (F.col("id") % 11).cast("int").alias("distance"),
            F.date_add(F.lit("2016-05-16").cast("date"),
                       F.when(hot, F.lit(0)).otherwise(F.col("id") % 31).cast("int")).alias("date_received"),
            F.lit(None).cast("date").alias("date"))
        out = B.simple_features(prep.prepare_b(df))
        got = (out.where(F.col("user_id") == 1)
                  .select("simple_User_id_Coupon_id_Date_received_receive_cnt").distinct().collect())
        assert [r[0] for r in got] == [n // 3]
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


PLAN_ONLY_SKIP = {"ml_score", "ml_importance", "ml_score_a", "ml_importance_a", "ml_validate",
                  "kmeans_fit", "ml_offline_rows", "ml_prediction_files", "ml_rounds", "ml_round_rows",
                  "ml_score_a_rows", "kmeans_restarts"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PLAN_ONLY_SKIP))
def test_plans_have_no_python_udf_and_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in plan, (name, bad)
