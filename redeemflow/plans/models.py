"""End-to-end model flows of both families, and their file outputs.

Family B (baseline): train + validate assembled sets -> GBT -> score the
July set -> (user, coupon, date_received, prob).
Family A: datasets of sets 1 and 2, label -1 -> 0, each deduplicated after
the column drop, stacked -> GBT without ``day_gap_*`` -> score set 3 ->
min-max scaled score -> sorted by (coupon_id, score).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF
from redeemflow.operators import ml
from redeemflow.plans import assemble
from redeemflow.session import scratch_path
from redeemflow.sources import offline_test, write_csv

#: Rounds, step and sampling of the reference (fixed values), thousands of sequential
#: trees.  ``b_fit`` runs its own; pass them to another flow to run them, e.g.
#: ``a_fit(log, **REFERENCE_A)``.
REFERENCE_B = {"max_iter": 5167, "step_size": 0.01, "max_depth": 5, "subsample": 0.9, "feature_subset": "0.7"}
REFERENCE_A = {"max_iter": 3500, "step_size": 0.01, "max_depth": 5, "subsample": 0.7, "feature_subset": "0.7"}

A_NOT_FEATURES = ["user_id", "coupon_id", "date_received", "label",
                  "day_gap_before", "day_gap_after"]


def _written(df: DataFrame, name: str) -> DataFrame:
    """Scored rows, written once to the shared folder: later steps read them
    instead of assembling and scoring again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def b_fit(log: DataFrame, grain: DataFrame | None = None, **settings) -> tuple[PipelineModel, list[str]]:
    """Fit on train + validate.  ``settings`` are those of ``ml.fit_gbt`` (rounds,
    step, depth, sampling, seed), the reference's own where not given; ``grain``, here and
    below, is the stored table of day-grain partials (``assemble``)."""
    train = assemble.b_big_train(log, grain=grain)
    features = ml.feature_columns(train, assemble.B_ID_COLUMNS + ["label"])
    return ml.fit_gbt(train, features, **{**REFERENCE_B, **settings}), features


def b_offline_fit(log: DataFrame, grain: DataFrame | None = None, **settings) -> tuple[PipelineModel, list[str]]:
    """M7: fit on the train set alone, the validate set held out."""
    train = assemble.b_dataset(log, "train", grain=grain)
    features = ml.feature_columns(train, assemble.B_ID_COLUMNS + ["label"])
    return ml.fit_gbt(train, features, **settings), features


def b_offline(log: DataFrame, fitted: tuple[PipelineModel, list[str]] | None = None,
              grain: DataFrame | None = None, **settings) -> DataFrame:
    """M7, the offline run: fit on the train set (or take ``fitted``), score the
    validate set (ids, label, prob), written once."""
    model, features = fitted or b_offline_fit(log, grain, **settings)
    scored = ml.score(model, assemble.b_dataset(log, "validate", grain=grain), features, [*assemble.B_ID_COLUMNS, "label"])
    return _written(scored, "offline-scores")


def b_watch(log: DataFrame, fitted: tuple[PipelineModel, list[str]], rounds: list[int] | None = None,
            grain: DataFrame | None = None) -> DataFrame:
    """M1/M7's watch list, long: ``part`` (train, validate), ``round``, auc, positives,
    negatives.  The sets are assembled in one plan and scored once for all rounds."""
    model, features = fitted
    both = assemble.b_sets(log, ["train", "validate"], grain=grain)
    return ml.exact_auc_by(ml.round_scores(model, both, features, ["part", "label"], rounds), ["part", "round"], "prob", "label")


def curve(watch: DataFrame) -> DataFrame:
    """The watch list with one row per round: ``round, auc_train, auc_validate``."""
    return watch.groupBy("round").agg(*[F.max(F.when(F.col("part") == p, F.col("auc"))).alias(f"auc_{p}")
                                        for p in ("train", "validate")])


def best_rounds(watch: DataFrame) -> int:
    """Rounds with the highest AUC on the validate set, the fewest of equals: the number
    to refit with on train + validate, at the step of the watched fit (``b_fit(log, max_iter=...,
    step_size=...)``)."""
    return curve(watch).orderBy(F.desc("auc_validate"), "round").first()["round"]


def b_validate(log: DataFrame, **settings) -> DataFrame:
    """M7: exact AUC of the offline run (one row)."""
    return ml.exact_auc(b_offline(log, **settings), "prob", "label")


def b_predictions(log: DataFrame, model: PipelineModel, features: list[str], grain: DataFrame | None = None) -> DataFrame:
    test = assemble.b_dataset(log, "test", offline_test(log), grain=grain)
    return ml.score(model, test, features, assemble.B_ID_COLUMNS)


def a_train_set(log: DataFrame, grain: DataFrame | None = None) -> DataFrame:
    """Sets 1 and 2 with the training label, each deduplicated, stacked."""
    both = assemble.a_sets(log, [1, 2], grain=grain)
    return both.select(*[RF.label_for_training("label").alias("label") if c == "label" else F.col(c)
                         for c in both.columns]).distinct().drop("part")


def a_fit(log: DataFrame, grain: DataFrame | None = None, **settings) -> tuple[PipelineModel, list[str]]:
    """Fit on sets 1 + 2; ``settings`` as for ``b_fit`` (row sampling 0.7 by default)."""
    train = a_train_set(log, grain)
    features = ml.feature_columns(train, A_NOT_FEATURES)
    return ml.fit_gbt(train, features, **{"subsample": 0.7, **settings}), features


def a_predictions(log: DataFrame, model: PipelineModel, features: list[str], grain: DataFrame | None = None) -> DataFrame:
    """Set 3 scored, the score min-max scaled into ``label`` (the
    reference's output column name), sorted by (coupon_id, label)."""
    test = assemble.a_dataset(log, 3, offline_test(log), grain).distinct()
    scored = _written(ml.score(model, test, features, ["user_id", "coupon_id", "date_received"]), "scores-a")
    scaled = ml.min_max_scale(scored, "prob", "label").drop("prob")
    return scaled.orderBy("coupon_id", "label")


def write_predictions(preds: DataFrame, path: str) -> None:
    """Headerless CSV, ids as integers, dates as yyyyMMdd."""
    write_csv(preds, path, header=False)


def write_importance(imp: DataFrame, path: str) -> None:
    """``feature,score`` CSV with a header; the score is the number of splits, most
    first (as many rows as features that are used)."""
    out = imp.select("feature", F.col("splits").alias("score")).orderBy(F.desc("score"), "feature")
    write_csv(out.coalesce(1), path, header=True)
