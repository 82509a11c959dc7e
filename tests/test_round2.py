"""Restarts, strict inputs, zero-filled axes, join layout and model flows."""

import os
import re
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import log_df
from redeemflow.operators import eda, kmeans, ml, split
from redeemflow.operators.receipts import pair_day_stats
from redeemflow.plans import assemble, models
from redeemflow.plans.queries import QUERIES
from redeemflow.sources import coupon_log, malformed, read_matrix_csv

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SESSION = """
import sys
from redeemflow.session import build_session
from redeemflow.sources import materialize_log
from redeemflow.streaming import ingest
root, src, out = sys.argv[1:]
spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": root})
path = materialize_log(spark, "/root/testdata/sf0.001")
ingest(spark, src, out).awaitTermination()
print("ROWS", spark.read.parquet(out).count(), path)
"""


def test_a_second_session_goes_on_where_the_first_stopped():
    tmp = tempfile.mkdtemp(prefix="rf-two-sessions-")
    src, out, root = (os.path.join(tmp, x) for x in ("src", "out", "root"))
    os.makedirs(src)

    def session():
        got = subprocess.run([sys.executable, "-c", SESSION, root, src, out], cwd=REPO, capture_output=True,
                             text=True, timeout=200, env=os.environ | {"PYTHONPATH": REPO})
        found = re.search(r"ROWS (\d+) (\S+)", got.stdout)
        assert found, got.stderr[-2000:]
        return int(found[1]), found[2]

    with open(os.path.join(src, "day1.csv"), "w") as f:
        f.write("1,2,null,null,0,null,20160217\n3,4,11002,150:20,1,20160528,null\n")
    rows, log1 = session()
    written = os.path.getmtime(os.path.join(log1, "_SUCCESS"))
    with open(os.path.join(src, "day2.csv"), "w") as f:
        f.write("5,6,7,0.9,2,20160601,20160603\n")
    again, log2 = session()
    assert (rows, again) == (2, 3)
    assert log1 == log2 and os.path.getmtime(os.path.join(log2, "_SUCCESS")) == written


def test_ingest_wants_a_lasting_root(spark):
    from redeemflow.streaming import ingest
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError):
            ingest(spark, "/tmp/none", "/tmp/none-out")


def test_kmeans_never_returns_an_unfinished_result(spark):
    pts = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    with pytest.raises(RuntimeError):
        kmeans.kmeans(pts, 4, "vec_id", max_iter=1)
    cents, out = kmeans.kmeans(pts, 4, "vec_id")
    again = kmeans.lloyd_step(pts, cents).collect()
    assert all(abs(r["mean"] - cents[r["cluster"]][r["position"]]) < 1e-9 for r in again)
    assert out.count() == pts.count()


@pytest.mark.parametrize("line", ["x\t2.0", "\t2.0", "1.0"])
def test_matrix_reader_drops_no_line(spark, line):
    path = os.path.join(tempfile.mkdtemp(prefix="rf-mat-"), "m.txt")
    with open(path, "w") as f:
        f.write(f"1.0\t2.0\n{line}\n3.0\t4.0\n")
    with pytest.raises(Exception):
        read_matrix_csv(spark, path, 2).collect()


def test_malformed_cells_are_counted(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rf-bad-"), "m.csv")
    with open(path, "w") as f:
        f.write("1,2,c7,0.9,1,20160101,null\n1,x,null,30:5,q,2016-01-01,nan\n3,4,5,0.9,2.0,20160101.0,20161301\n")
    got = {r.column_name: r.cells for r in malformed(spark, path, header=False).collect()}
    assert got == {"user_id": 0, "merchant_id": 1, "coupon_id": 1, "discount_rate": 0, "distance": 1,
                   "date_received": 1, "date": 1}


def test_absent_weekdays_and_months_count_zero(spark):
    rows = [(1, 1, 1, "30:5", 1, "05-02", None), (1, 1, 1, "30:5", 1, "02-01", "02-03")]  # Mondays
    days = {r.weekday: (r.received, r.redeemed) for r in eda.weekday(log_df(spark, rows)).collect()}
    assert days == {1: (2, 1), **{d: (0, 0) for d in range(2, 8)}}
    months = {r.month: (r.received, r.redeemed, r.consumed) for r in eda.monthly(log_df(spark, rows)).collect()}
    assert months == {2: (1, 1, 1), 3: (0, 0, 0), 4: (0, 0, 0), 5: (1, 0, 0)}


def test_two_texts_of_one_rate_are_one_row(spark):
    rows = [(1, 1, 1, t, 1, "05-20", None) for t in ("0.9", "0.90")] + [(1, 1, 1, "0.9", 1, "03-01", "03-02")]
    assert assemble.a_dataset(log_df(spark, rows), 2).count() == 1


def final_plan(spark, df, broadcast: bool):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "32MB" if broadcast else "-1")
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


@pytest.mark.parametrize("name", ["a_dataset_train", "ds_assemble"])
def test_rows_do_not_move_by_merchant_or_coupon(spark, name):
    plan = final_plan(spark, QUERIES[name](spark, SF_SMALL), True)
    assert "BroadcastHashJoin" in plan
    plan = final_plan(spark, QUERIES[name](spark, SF_SMALL), False)
    # without broadcasts: the closing distinct has an exchange of its own
    top = plan[:plan.index("SortMergeJoin")]
    if name == "ds_assemble":
        assert "Exchange hashpartitioning" in top


def test_pair_statistics_need_two_scans_and_four_shuffles(spark):
    for name in ("a_first_last", "a_day_gap"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") <= 2, name
        assert plan.count("Exchange hashpartitioning") <= 4, name


def test_hot_merchant_and_coupon_give_exact_sets(spark):
    lg = coupon_log(spark, SF_SMALL)
    hot = F.col("user_id") % 3 == 0
    skewed = lg.withColumn("merchant_id", F.when(hot, 0).otherwise(F.col("merchant_id")).cast("long")).withColumn(
        "coupon_id", F.when(hot & F.col("coupon_id").isNotNull(), 0).otherwise(F.col("coupon_id")).cast("long"))
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    for build in (lambda: assemble.a_dataset(skewed, 2), lambda: assemble.b_dataset(skewed, "train")):
        old = spark.conf.get(key)
        with_broadcast = build().agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(20,0)"))).first()
        spark.conf.set(key, "-1")
        try:
            without = build().agg(F.count("*"), F.sum(F.xxhash64("*").cast("decimal(20,0)"))).first()
        finally:
            spark.conf.set(key, old)
        assert with_broadcast == without and without[0] > 0


def test_pair_statistics_of_a_hot_pair(spark):
    rows = [(1, 1, 1, "30:5", 1, f"05-{15 + i % 10:02d}", None) for i in range(200)]
    got = pair_day_stats(log_df(spark, rows)).collect()
    assert len(got) == 10 and all(r.n_uc == 200 and r.n_ucd == 20 for r in got)


# ------------------------------------------------------------------ model flows
def test_offline_run_scores_every_validate_row(spark):
    lg = coupon_log(spark, SF_SMALL)
    scored = models.b_offline(lg, max_iter=3, seed=1)
    assert scored.count() == assemble.b_dataset(lg, "validate").count()
    assert scored.where("prob < 0 or prob > 1 or prob is null").count() == 0
    again = models.b_offline(lg, max_iter=3, seed=1)
    key = ["user_id", "coupon_id", "date_received", "label", "prob"]
    assert sorted(map(tuple, scored.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))


def test_trained_scores_beat_the_discount_alone(spark):
    lg = coupon_log(spark, SF_SMALL)
    train = assemble.b_dataset(lg, "train")
    features = ml.feature_columns(train, assemble.B_ID_COLUMNS + ["label"])
    scored = ml.score(ml.fit_gbt(train, features, max_iter=5), train, features, ["label", "discount_rate"])
    trained = ml.exact_auc(scored, "prob", "label").first().auc
    alone = ml.exact_auc(scored, "discount_rate", "label").first().auc
    assert trained > max(alone, 1 - alone)


def test_family_a_flow(spark):
    lg = coupon_log(spark, SF_SMALL)
    model, features = models.a_fit(lg, max_iter=2)
    assert not {"day_gap_before", "day_gap_after"} & set(features)
    got = models.a_predictions(lg, model, features).collect()
    assert [(r.coupon_id, r.label) for r in got] == sorted((r.coupon_id, r.label) for r in got)
    assert min(r.label for r in got) == 0.0 and max(r.label for r in got) == 1.0
    assert {"max_iter", "step_size"} <= set(models.REFERENCE_A) & set(models.REFERENCE_B)


def test_auc_in_one_and_many_buckets(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 997 / 997).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    one, many = (ml.exact_auc(df, "s", "y", buckets=b).first() for b in (1, 50))
    assert one.auc == pytest.approx(many.auc, abs=1e-12) and one.positives == many.positives


def test_split_dates_are_the_ones_the_plans_use():
    assert split.A_SETS[2].anchor == "2016-05-14"
