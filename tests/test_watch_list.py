"""The watch list: AUC per boosting round, rounds chosen on the held-out set."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from redeemflow.operators import ml
from redeemflow.plans import models
from redeemflow.plans.queries import _model


def noisy(spark, n, seed):
    rng = random.Random(seed)
    rows = [(x, rng.random(), int(x + rng.gauss(0, 0.4) > 0.5)) for x in (rng.random() for _ in range(n))]
    return spark.createDataFrame(rows, "x double, noise double, label int")


def test_prefixes_are_the_scores_of_shorter_models(spark):
    df = noisy(spark, 300, 1).withColumn("i", F.monotonically_increasing_id())
    features = ["x", "noise"]
    full = ml.fit_gbt(df, features, max_iter=6, subsample=1.0)
    short = ml.fit_gbt(df, features, max_iter=3, subsample=1.0)
    got = {(r["i"], r["round"]): r.prob for r in ml.round_scores(full, df, features, ["i"]).collect()}
    assert len(got) == 300 * 6
    for model, k in ((full, 6), (short, 3)):
        for r in ml.score(model, df, features, ["i"]).collect():
            assert got[r["i"], k] == pytest.approx(r.prob, abs=1e-12)
    some = ml.round_scores(full, df, features, ["i"], rounds=[2, 5])
    assert {(r["i"], r["round"]): r.prob for r in some.collect()} == {k: v for k, v in got.items() if k[1] in (2, 5)}


@pytest.mark.parametrize("buckets", [1, 40])
def test_grouped_auc_equals_single_ones(spark, buckets):
    df = spark.range(4000).select((F.col("id") % 3).cast("int").alias("g"), (F.col("id") * 7919 % 997 % 50 / 50).alias("s"),
                                  (F.col("id") % 7 < F.col("id") % 3).cast("int").alias("y"))
    got = {r.g: r for r in ml.exact_auc_by(df, ["g"], "s", "y", buckets).collect()}
    for g in range(3):
        want = ml.exact_auc(df.where(F.col("g") == g), "s", "y").first()
        assert (got[g].positives, got[g].negatives) == (want.positives, want.negatives)
        assert got[g].auc == (want.auc if want.auc is None else pytest.approx(want.auc, abs=1e-12))


def test_curve_of_the_offline_run(spark):
    lg, *fitted = _model(spark, SF_SMALL, "b-offline")
    watch = models.b_watch(lg, fitted).cache()
    rows = {r["round"]: r for r in models.curve(watch).collect()}
    assert sorted(rows) == list(range(1, ml.ROUNDS + 1))
    assert rows[ml.ROUNDS].auc_validate == pytest.approx(models.b_validate(lg, fitted=fitted).first().auc, abs=1e-9)
    assert rows[ml.ROUNDS].auc_train > rows[1].auc_train
    best = models.best_rounds(watch)
    assert rows[best].auc_validate == max(r.auc_validate for r in rows.values())
    watch.unpersist()


def test_importance_counts_splits_of_used_features(spark):
    df = noisy(spark, 200, 2).withColumn("constant", F.lit(1.0))
    model = ml.fit_gbt(df, ["constant", "noise", "x"], max_iter=3, max_depth=2)
    got = ml.importance(model, ["constant", "noise", "x"], spark).collect()
    assert "constant" not in {r.feature for r in got}
    assert [r.splits for r in got] == sorted((r.splits for r in got), reverse=True)
    assert sum(r.splits for r in got) == sum((t.numNodes - 1) // 2 for t in model.stages[-1].trees)
