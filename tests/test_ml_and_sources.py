"""Learning operators and file sources."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import log_df
from redeemflow.operators import kmeans, ml
from redeemflow.sources import read_log_csv, read_matrix_csv, write_csv


def test_exact_auc_matches_pairwise_count(spark):
    random.seed(1)
    rows = [(random.choice([0.1, 0.2, 0.3, 0.5, 0.9]), random.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "s double, y int")
    got = ml.exact_auc(df, "s", "y", buckets=4).collect()[0].auc
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


def test_gbt_learns_planted_signal(spark):
    random.seed(2)
    rows = []
    for _ in range(400):
        x = random.random()
        rows.append((x, random.random(), 1 if x + random.gauss(0, 0.1) > 0.5 else 0))
    df = spark.createDataFrame(rows, "x double, noise double, label int")
    model = ml.fit_gbt(df, ["x", "noise"], max_iter=5)
    scored = ml.score(model, df, ["x", "noise"], ["label"])
    auc = ml.exact_auc(scored, "prob", "label").collect()[0].auc
    assert auc > 0.9
    imp = ml.importance(model, ["x", "noise"], spark).collect()
    assert max(imp, key=lambda r: r.importance).feature == "x" and imp[0].splits > 0


def test_min_max_scale(spark):
    df = spark.createDataFrame([(2,), (4,), (6,)], "v int")
    got = [r.s for r in ml.min_max_scale(df, "v", "s").orderBy("v").collect()]
    assert got == [0.0, 0.5, 1.0]


def test_kmeans_converges_on_separated_blobs(spark):
    random.seed(4)
    pts = [(i, [random.gauss(c, 0.05), random.gauss(c, 0.05)]) for i, c in
           enumerate([0.0] * 20 + [5.0] * 20)]
    df = spark.createDataFrame(pts, "vec_id long, embedding array<double>")
    cents, assigned = kmeans.kmeans(df, 2, "vec_id")
    clusters = {r.vec_id: r.cluster for r in assigned.collect()}
    assert len({clusters[i] for i in range(20)}) == 1
    assert len({clusters[i] for i in range(20, 40)}) == 1
    assert clusters[0] != clusters[39]


def test_kmeans_assign_ties_go_to_lower_index(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0])], "vec_id long, embedding array<double>")
    r = kmeans.assign(df, [[1.0, 0.0], [-1.0, 0.0]]).collect()[0]
    assert r.cluster == 0 and r.distance == 1.0


def test_csv_headerless_with_null_tokens_and_float_dates(spark):
    tmp = tempfile.mkdtemp(prefix="rf-csv-")
    p = os.path.join(tmp, "log.csv")
    with open(p, "w") as f:
        f.write("1,2,null,null,0,null,20160217\n")
        f.write("3,4,11002,150:20,1,20160528.0,null\n")
    df = read_log_csv(spark, p, header=False)
    rows = df.collect()
    assert rows[0].coupon_id is None and rows[0].date.isoformat() == "2016-02-17"
    assert rows[1].coupon_id == 11002 and rows[1].date_received.isoformat() == "2016-05-28"
    assert rows[1].date is None


def test_csv_roundtrip(spark):
    lg = log_df(spark, [(1, 1, 3, "30:5", None, "05-25", None), (2, 1, None, None, 4, None, "05-02")])
    out = os.path.join(tempfile.mkdtemp(prefix="rf-csv-"), "o")
    write_csv(lg, out)
    back = read_log_csv(spark, out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, lg.collect()))


def test_matrix_reader(spark):
    tmp = tempfile.mkdtemp(prefix="rf-mat-")
    p = os.path.join(tmp, "m.txt")
    with open(p, "w") as f:
        f.write("1.0\t2.0\n3.0\t4.0\n")
    df = read_matrix_csv(spark, p, 2)
    assert sorted(r.features for r in df.collect()) == [[1.0, 2.0], [3.0, 4.0]]


def test_embeddings_step_has_k_times_d_rows(spark):
    pts = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    cents = kmeans.first_k(pts, 4, "vec_id")
    means = kmeans.lloyd_step(pts, cents)
    assert means.count() <= 4 * 64
    assert means.where(F.col("mean").isNull()).count() == 0


def test_streaming_ingest_appends_new_files_once(spark):
    from redeemflow.streaming import ingest

    src = tempfile.mkdtemp(prefix="rf-stream-src-")
    out = os.path.join(tempfile.mkdtemp(prefix="rf-stream-out-"), "log")
    with open(os.path.join(src, "day1.csv"), "w") as f:
        f.write("1,2,null,null,0,null,20160217\n3,4,11002,150:20,1,20160528,null\n")
    name, root = f"t{random.randint(0, 10**9)}", tempfile.mkdtemp(prefix="rf-stream-root-")
    ingest(spark, src, out, name=name, root=root).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    with open(os.path.join(src, "day2.csv"), "w") as f:
        f.write("5,6,7,0.9,2,20160601,20160603\n")
    ingest(spark, src, out, name=name, root=root).awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() == 3
    assert df.where(F.col("user_id") == 5).first().date.isoformat() == "2016-06-03"


def test_prediction_and_importance_writers(spark):
    from redeemflow.plans.models import write_importance, write_predictions

    preds = spark.createDataFrame([(1, 7, "2016-07-02", 0.25)],
                                  "user_id long, coupon_id long, date_received string, prob double"
                                  ).withColumn("date_received", F.to_date("date_received"))
    out = os.path.join(tempfile.mkdtemp(prefix="rf-pred-"), "p")
    write_predictions(preds, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out))
                   if f.startswith("part-"))
    assert text.strip() == "1,7,20160702,0.25"
    imp = spark.createDataFrame([("a", 0.2, 1), ("b", 0.8, 3)], "feature string, importance double, splits long")
    out2 = os.path.join(tempfile.mkdtemp(prefix="rf-imp-"), "i")
    write_importance(imp, out2)
    text2 = "".join(open(os.path.join(out2, f)).read() for f in sorted(os.listdir(out2))
                    if f.startswith("part-"))
    assert text2.splitlines() == ["feature,score", "b,3", "a,1"]


def test_online_log_reader(spark):
    from redeemflow.sources import read_online_csv

    tmp = tempfile.mkdtemp(prefix="rf-online-")
    p = os.path.join(tmp, "on.csv")
    with open(p, "w") as f:
        f.write("13740231,18907,2,100017492,500:50,20160513,null\n")
    r = read_online_csv(spark, p).collect()[0]
    assert (r.action, r.coupon_id, r.date_received.isoformat(), r.date) == (
        2, "100017492", "2016-05-13", None)


def test_kmeans_fit_matches_plain_lloyd(spark):
    """kmeans_fit against a plain numpy Lloyd's (same start: the 4 lowest
    vec_id; same stop: no point changes cluster) on the smallest table."""
    import numpy as np

    import __spark_entry__ as E

    pts = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    ids = [r.vec_id for r in pts]
    x = np.array([r.embedding for r in pts], dtype=np.float64)
    c = x[:4].copy()
    assign = None
    for _ in range(100):
        dist = np.sqrt(((x[:, None, :] - c[None, :, :]) ** 2).sum(-1))
        new = dist.argmin(1)
        if assign is not None and (new == assign).all():
            break
        assign = new
        for j in range(4):
            if (assign == j).any():
                c[j] = x[assign == j].mean(0)
    expect = dict(zip(ids, assign.tolist()))
    got = {r.vec_id: r.cluster for r in E.queries()["kmeans_fit"](spark, SF_SMALL).collect()}
    assert got == expect


def test_materialized_log_equals_view_and_is_reused(spark):
    from redeemflow.sources import coupon_log, coupon_view, materialize_log

    path = materialize_log(spark, SF_SMALL)
    assert materialize_log(spark, SF_SMALL) == path  # published once, then reused
    files = [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]
    assert len(files) >= spark.sparkContext.defaultParallelism
    stored, view = coupon_log(spark, SF_SMALL), coupon_view(spark, SF_SMALL)
    assert stored.schema == view.schema
    assert stored.exceptAll(view).count() == 0 and view.exceptAll(stored).count() == 0


def test_headered_csv_with_float_dates(spark):
    tmp = tempfile.mkdtemp(prefix="rf-hdr-")
    p = os.path.join(tmp, "h.csv")
    with open(p, "w") as f:
        f.write("User_id,Merchant_id,Coupon_id,Discount_rate,Distance,Date_received,Date\n")
        f.write("1439408,2632,8591.0,20:1,0.0,20160217.0,\n")
        f.write("1439408,4663,,,1.0,,20160305.0\n")
    rows = read_log_csv(spark, p, header=True).collect()
    assert rows[0].coupon_id == 8591 and rows[0].distance == 0
    assert rows[0].date_received.isoformat() == "2016-02-17" and rows[0].date is None
    assert rows[1].coupon_id is None and rows[1].date.isoformat() == "2016-03-05"
