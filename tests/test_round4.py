"""The reference's rounds, grown in one task by the rules of Spark's own trees."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from redeemflow.operators import boost, ml
from redeemflow.plans import models
from redeemflow.plans import queries as Q


def _rows(spark, n=400):
    h = [F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(m)) for i, m in enumerate((97, 5, 200, 2, 1))]
    x = [c.cast("double").alias(f"x{i}") for i, c in enumerate(h)]
    noise = F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(40))
    return spark.range(n).select(*x, (h[0] + 30 * h[3] + noise > 70).cast("int").alias("label"))


def _shape(model):
    """Weight and text of every tree, numbers to nine places."""
    import re
    return [(t, re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda x: f"{float(x.group()):.9f}", tree.toDebugString.split("\n", 1)[1]))
            for t, tree in zip(model.stages[-1].treeWeights, model.stages[-1].trees)]


def test_b_fit_runs_the_settings_of_the_reference(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(ml, "fit_gbt", lambda train, features, **settings: seen.update(settings))
    models.b_fit(Q.log(spark, SF_SMALL))
    assert seen == models.REFERENCE_B and seen["max_iter"] == 5167
    models.b_fit(Q.log(spark, SF_SMALL), max_iter=1)
    assert seen["max_iter"] == 1 and seen["step_size"] == 0.01


def test_one_task_grows_the_trees_of_spark(spark, monkeypatch):
    """Without draws both are one algorithm: the same splits, leaf values, gains (nodes large enough
    that no two features part them alike, where rounding would choose)."""
    df, features = _rows(spark, 4000), [f"x{i}" for i in range(5)]
    settings = dict(max_iter=6, step_size=0.1, subsample=1.0, feature_subset="all", max_depth=3)
    theirs = ml.fit_gbt(df, features, **settings)
    monkeypatch.setattr(ml, "MANY_ROUNDS", 1)
    ours = ml.fit_gbt(df, features, **settings)
    assert _shape(ours) == _shape(theirs)
    a, b = (m.stages[-1].featureImportances.toArray().tolist() for m in (ours, theirs))
    assert a == pytest.approx(b, abs=1e-9) and sum(a) > 0
    assert ml.split_counts(ours, 5) == ml.split_counts(theirs, 5)
    assert sum(ml.split_counts(ours, 5)) == sum(t.numNodes // 2 for t in ours.stages[-1].trees)
    p, q = ([r.prob for r in ml.score(m, df, features, []).collect()] for m in (ours, theirs))
    assert p == pytest.approx(q, abs=1e-9)


def test_rows_rest_in_leaves_of_any_level(spark, monkeypatch):
    """Some leaves are done early while others are split on (where a leaf is pure, Spark may split it by what
    rounding leaves, so scores are compared)."""
    df = spark.range(60).select((F.col("id") % 30).cast("double").alias("x"), F.when(F.col("id") % 30 > 12, F.lit(1)).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(2))).cast("int").alias("label"))
    settings = dict(max_iter=4, subsample=1.0, feature_subset="all", max_depth=6)
    theirs = ml.fit_gbt(df, ["x"], **settings)
    monkeypatch.setattr(ml, "MANY_ROUNDS", 1)
    p, q = ([r.prob for r in ml.score(m, df, ["x"], ["x"]).orderBy("x").collect()] for m in (ml.fit_gbt(df, ["x"], **settings), theirs))
    assert p == pytest.approx(q, abs=1e-9) and len(set(p)) > 4


def test_draws_of_one_task(spark, monkeypatch):
    """The same model however the rows are dealt; sampled rows and features; larger sets go to Spark's trees."""
    monkeypatch.setattr(ml, "MANY_ROUNDS", 1)
    df, features = _rows(spark), [f"x{i}" for i in range(5)]
    settings = dict(max_iter=12, subsample=0.7, feature_subset="0.5", seed=3)
    one, other = ml.fit_gbt(df.repartition(1), features, **settings), ml.fit_gbt(df.repartition(7, "x0"), features, **settings)
    assert _shape(one) == _shape(other) and len(_shape(one)) == 12
    rows = [int(r.nodeData.rawCount) for r in _nodes(spark, one) if r.nodeData.id == 0]
    assert all(200 < n < 360 for n in rows) and len(set(rows)) > 1
    monkeypatch.setattr(boost, "ONE_TASK_ROWS", 399)
    monkeypatch.setattr(boost, "fit", None)
    assert len(ml.fit_gbt(df, features, max_iter=1).stages[-1].trees) == 1


def _nodes(spark, model):
    from redeemflow.session import scratch_path
    path = scratch_path(spark, "model-test")
    model.stages[-1].write().save(path)
    return spark.read.parquet(f"{path}/data").collect()


def test_one_task_refuses_what_spark_refuses(spark, monkeypatch):
    monkeypatch.setattr(ml, "MANY_ROUNDS", 1)
    for bad in (spark.createDataFrame([(1.0, 0), (2.0, None)], "x double, label int"),
                spark.createDataFrame([(1.0, 0), (2.0, 3)], "x double, label int"),
                spark.createDataFrame([(1.0, 0), (float("nan"), 1)], "x double, label int"),
                spark.createDataFrame([], "x double, label int")):
        with pytest.raises(Exception):
            ml.fit_gbt(bad, ["x"], max_iter=2)
    flat = ml.fit_gbt(spark.createDataFrame([(None, 1), (None, 1)], "x double, label int"), ["x"], max_iter=2)
    assert [t.numNodes for t in flat.stages[-1].trees] == [1, 1] and ml.split_counts(flat, 1) == [0]


def test_many_trees_score_on_all_cores(spark, monkeypatch):
    df, features = _rows(spark, 60), [f"x{i}" for i in range(5)]
    model = ml.fit_gbt(df, features, max_iter=3)
    want = sorted(r.prob for r in ml.score(model, df.coalesce(1), features, ["label"]).collect())
    monkeypatch.setattr(ml, "MANY_ROUNDS", 3)
    monkeypatch.setattr(ml, "SCORE_ROWS", 10)
    scored = ml.score(model, df.coalesce(1), features, ["label"])
    assert scored.rdd.getNumPartitions() == 6
    assert sorted(r.prob for r in scored.collect()) == want
