"""Whole importance file, one parse per line, shared K-means passes, bounded merges and fits."""

from __future__ import annotations

import tempfile

from conftest import SF_SMALL
from helpers import log_df
from pyspark.sql import functions as F

from redeemflow.operators import daygrain, kmeans, ml, prep
from redeemflow.plans import models
from redeemflow.plans import queries as Q
from redeemflow.sources import read_log_checked
from redeemflow.sources.log import log_table_path

ROWS = [(1, 5, 7, "0.9", 1, "03-05", "03-07"), (1, 5, 8, "30:5", None, "03-05", None), (1, None, 7, "0.9", 3, "03-06", "03-06"),
        (None, 5, None, "0.9", 3, "03-06", "03-26"), (2, 5, 7, "0.9", 0, "03-05", None), (2, 6, None, None, None, None, "04-01")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_feature_is_judged_by_the_importance_file(spark, monkeypatch):
    """A model of one tree uses few of the 39 features; all are counted."""
    lg = Q.log(spark, SF_SMALL)
    key = (spark.sparkContext.applicationId, log_table_path(spark, SF_SMALL), "b")
    model, features = models.b_fit(lg, max_iter=1)
    monkeypatch.setitem(Q._MODELS, key, (model, features))
    assert len(features) == 39 > sum(n > 0 for n in ml.split_counts(model, 39))
    row = Q.QUERIES["ml_prediction_files"](spark, SF_SMALL).where("user_id = -1").collect()
    assert [(r["rows"], r.scored) for r in row] == [(39, True)]
    # a file that misses a used feature, or has one that no tree uses, is told
    write = models.write_importance
    for wrong in (lambda imp: imp.limit(imp.count() - 1),
                  lambda imp: imp.unionByName(spark.createDataFrame([("other", 0.0, 1)], imp.schema))):
        monkeypatch.setattr(models, "write_importance", lambda imp, path, wrong=wrong: write(wrong(imp), path))
        row = Q.QUERIES["ml_prediction_files"](spark, SF_SMALL).where("user_id = -1").collect()
        assert [(r["rows"], r.scored) for r in row] == [(39, False)]


def test_a_line_is_parsed_once(spark):
    folder = tempfile.mkdtemp(prefix="rf-parse-")
    spark.createDataFrame([("1,2,x3,0.9,1,20160305,null",), ("1,2,3,0.9,1,20160305,20160306",)], "value string").write.mode(
        "overwrite").text(folder)
    good, rejected = read_log_checked(spark, folder, header=False)
    for df in (good, rejected):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    assert good.count() == 1 and [r.reason for r in rejected.collect()] == ["coupon_id"]


def test_restarts_share_their_passes(spark):
    sc = spark.sparkContext
    pts = spark.range(0, 60).select(F.col("id").alias("vec_id"), F.array(*[
        ((F.col("id") * k) % 13).cast("float") for k in (3, 5, 7)]).alias("embedding"))

    def jobs(run):
        group = f"km-{run}-{id(run)}"
        sc.setJobGroup(group, group)
        out = run()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group)), out
    alone = [jobs(lambda s=s: kmeans.kmeans(pts, 4, "vec_id", start=kmeans.random_k(pts, 4, "vec_id", s)))for s in (1, 2, 3)]
    n, (seed, cents, _) = jobs(lambda: kmeans.restarts(pts, 4, "vec_id", [1, 2, 3]))
    assert cents == alone[seed - 1][1][0]
    assert n < sum(a[0] for a in alone)


def test_windows_merge_after_the_exchange_only(spark):
    """No map-side buffer of nearly distinct keys, and no copies of rows for distinct counts."""
    lg = log_df(spark, ROWS)
    plan = plan_of(daygrain.a_pairs(spark.createDataFrame(daygrain.a_grain(lg).collect(), daygrain.a_grain(lg).schema)))
    assert "HashAggregate" not in plan[plan.rindex("Exchange"):] and plan.count("Exchange hashpartitioning") == 1
    grain = daygrain.b_grain(prep.prepare_b(lg))
    merchant = daygrain.b_history(grain, {"w": ("2016-03-01", "2016-03-31")})["merchant"]
    assert "Expand" not in plan_of(merchant)
    got = {r.merchant_id: tuple(r)[2:] for r in merchant.collect()}
    # received, users, used, not used, coupons
    assert got == {5: (4, 2, 2, 2, 2), None: (1, 1, 1, 0, 1)}


def test_a_grain_moves_once(spark):
    lg = log_df(spark, ROWS)
    for made in (daygrain.a_grain(lg, 3), daygrain.b_grain(prep.prepare_b(lg), 3)):
        plan = plan_of(made.sortWithinPartitions("day", "user_id"))
        assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
        assert made.rdd.getNumPartitions() == 3
    key = lambda r: repr(tuple(r))
    for f in (daygrain.a_grain, lambda x, n=None: daygrain.b_grain(prep.prepare_b(x), n)):
        assert sorted(f(lg, 3).collect(), key=key) == sorted(f(lg).collect(), key=key)


def test_a_fit_runs_in_parts_of_bounded_size(spark, monkeypatch):
    """However few parts the training set comes in."""
    monkeypatch.setattr(ml, "TASK_ROWS", 10)
    seen = []
    dealt = ml._dealt
    monkeypatch.setattr(ml, "_dealt", lambda df: seen.append(dealt(df)) or seen[-1])
    train = spark.range(200).select((F.col("id") % 7).alias("x"), (F.col("id") % 7 > 3).cast("int").alias("label")).coalesce(1)
    model = ml.fit_gbt(train, ["x"], max_iter=1)
    assert seen[0].rdd.getNumPartitions() == 20 and not model.stages[-1].getCacheNodeIds()


def test_the_watch_list_assembles_both_sets_in_one_plan(spark, monkeypatch):
    calls = []
    both = models.assemble.b_sets
    monkeypatch.setattr(models.assemble, "b_sets", lambda log, names, *a, **k: calls.append(list(names)) or both(log, names, *a, **k))
    lg = Q.log(spark, SF_SMALL)
    fitted = models.b_offline_fit(lg, max_iter=1)
    calls.clear()
    watch = models.b_watch(lg, fitted).collect()
    assert calls == [["train", "validate"]] and {(r.part, r["round"]) for r in watch} == {("train", 1), ("validate", 1)}
