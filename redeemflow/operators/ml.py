"""Learning operators on ``pyspark.ml`` (M1-M7).

Boosted trees: ``GBTClassifier`` replaces xgboost (not available); its
loss, regularisation and missing-value handling differ, so scores are
compared for quality, never bit for bit.  GBT rejects null features, so
nulls are filled with a sentinel before the vector is assembled
(xgboost treats them as missing natively).
"""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from redeemflow.operators import boost
from redeemflow.session import scratch_path

MISSING = -999.0
NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType,
           T.DecimalType, T.BooleanType)


def feature_columns(df: DataFrame, exclude) -> list[str]:
    """M2: every numeric column except ids and the label."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and isinstance(f.dataType, NUMERIC)]


def _filled(df: DataFrame, features: list[str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c)
                       if c in features else F.col(c) for c in df.columns])


#: boosting rounds and step of a fit that is given none; README shows what more would give
ROUNDS, STEP = 20, 0.1
#: rounds from which on a training set of at most ``boost.ONE_TASK_ROWS`` rows is fitted in one task
MANY_ROUNDS = 100


def fit_gbt(train: DataFrame, features: list[str], label: str = "label", max_iter: int = ROUNDS,
            max_depth: int = 5, step_size: float = STEP, subsample: float = 0.9,
            feature_subset: str = "0.7", seed: int = 0) -> PipelineModel:
    """M1.  ``max_iter`` rounds at ``step_size`` are the caller's; the reference's own
    settings are ``models.REFERENCE_B`` / ``REFERENCE_A``.  Spark ML grows one tree
    after the other, one distributed pass per level, so thousands of rounds
    take hours; the defaults here are fewer rounds at a larger step.  Many rounds on a
    set that one task holds are grown there (``boost``), without a job per level."""
    spark = train.sparkSession
    # no cache of node ids: at most ``max_depth`` comparisons find a row's node, while the
    # cache keeps another copy of ids per level and reads every binned row twice for it
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample,
                        featureSubsetStrategy=feature_subset, seed=seed, cacheNodeIds=False)
    ckpt = spark.sparkContext.getCheckpointDir()
    if ckpt:
        gbt.setCheckpointInterval(10)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    data = _filled(train, features).select(*features, F.col(label).cast("double").alias(label))
    stored = _written(data, "train-set")
    if max_iter >= MANY_ROUNDS and stored.count() <= boost.ONE_TASK_ROWS:
        return PipelineModel(stages=[assembler, boost.fit(gbt, stored, features, label)])
    return Pipeline(stages=[assembler, gbt]).fit(_dealt(stored))


#: rows that one task scores under a model of many trees
SCORE_ROWS = 20_000
#: training rows of one task (binned rows of 40 features take some 300 bytes)
TASK_ROWS = 250_000


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(stored: DataFrame) -> DataFrame:
    """Rows of a stored table in as many parts as they ask for, and one per core at least:
    every pass of a fit runs over these parts, however the plan that made them was dealt."""
    parts = max(stored.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // TASK_ROWS))
    return stored.repartition(parts)


def score(model: PipelineModel, df: DataFrame, features: list[str],
          keep: list[str]) -> DataFrame:
    """M3: positive-class probability next to the id columns (same row).  Under a model of many
    trees a row takes milliseconds: the rows are stored and spread over all cores, since the plan
    that made them leaves them in as few parts as their bytes need."""
    if model.stages[-1].getNumTrees >= MANY_ROUNDS:
        df = _written(df, "score-set")
        df = df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // SCORE_ROWS)))
    out = model.transform(_filled(df, features))
    return out.select(*keep, vector_to_array("probability")[1].alias("prob"))


def round_scores(model: PipelineModel, df: DataFrame, features: list[str], keep: list[str],
                 rounds: list[int] | None = None) -> DataFrame:
    """M1's watch list: the probability after each boosting round (all, or those of
    ``rounds``), one row per row and round: ``keep``, ``round`` (from 1), ``prob``.

    One pass over the rows: each tree adds its leaf value to a running sum, and the
    sums after the wanted rounds are the scores of the shorter models.
    """
    gbt = model.stages[-1]
    out = model.stages[0].transform(_filled(df, features)).select(*keep, "features", F.lit(0.0).alias("_m0"))
    kept = []
    for i, (tree, weight) in enumerate(zip(gbt.trees, gbt.treeWeights), 1):
        out = tree.copy().setPredictionCol("_leaf").setFeaturesCol("features").transform(out)
        out = out.withColumn(f"_m{i}", F.col(f"_m{i - 1}") + F.lit(float(weight)) * F.col("_leaf"))
        old = [c for c in ("_leaf", f"_m{i - 1}") if c == "_leaf" or i - 1 not in kept]
        out = out.drop(*old)
        if rounds is None or i in rounds:
            kept.append(i)
    # the classifier's link: 1 / (1 + exp(-2 margin))
    at = [F.struct(F.lit(i).alias("round"), (1.0 / (1.0 + F.exp(-2.0 * F.col(f"_m{i}")))).alias("prob")) for i in kept]
    return out.select(*keep, F.explode(F.array(*at)).alias("_r")).select(*keep, "_r.round", "_r.prob")


def importance(model: PipelineModel, features: list[str], spark: SparkSession) -> DataFrame:
    """M5, O2: the number of split nodes per feature, most first, features that no tree
    uses left out; the share of the gain beside it."""
    gbt = model.stages[-1]
    gains = gbt.featureImportances.toArray().tolist()
    splits = split_counts(model, len(features))
    rows = [(f, float(g), int(s)) for f, g, s in zip(features, gains, splits) if s]
    schema = "feature string, importance double, splits long"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("splits"), "feature")


def split_counts(model: PipelineModel, n: int) -> list[int]:
    """Split nodes of all trees per feature, of ``n`` features.  A tree is read as one text, not
    node by node: models of the reference's size have hundreds of thousands."""
    splits = [0] * n
    for tree in model.stages[-1]._call_java("trees"):
        for f in re.findall(r"If \(feature (\d+) ", tree.toDebugString()):
            splits[int(f)] += 1
    return splits


def min_max_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """M4: (x - min) / (max - min) over the whole column, via scalar
    subqueries (two aggregates, no join); constant column -> 0."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    scaled = F.try_divide((F.col(col) - lo).cast("double"), (hi - lo).cast("double"))
    return df.select("*", F.coalesce(scaled, F.lit(0.0)).alias(out))


#: distinct scores that one task sorts
AUC_BUCKET = 1_000_000
#: buckets at least and at most (their bounds and totals pass through the driver)
AUC_BUCKETS = (8, 4096)


def exact_auc(df: DataFrame, score_col: str, label_col: str, buckets: int | None = None) -> DataFrame:
    """M6: exact ROC AUC (average ranks for ties) as a one-row DataFrame.

    AUC = sum over score values s of pos(s) * (neg_below(s) + neg(s) / 2)
          / (P * N).
    Counts are first aggregated per distinct score (partial aggregation) and
    written to the shared folder, so the input is evaluated once.  The running count of
    negatives below each score is a prefix sum done in quantile buckets of the
    score: each bucket is sorted in its own task and starts from the total of
    the buckets below it.  There are as many buckets as the number of distinct
    scores asks for; only their bounds and totals pass through the driver.
    """
    g = (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(F.col(score_col).cast("double").alias("s"))
           .agg(F.count(F.when(F.col(label_col) == 1, 1)).alias("pos"),
                F.count(F.when(F.col(label_col) != 1, 1)).alias("neg")))
    g = _written(g, "score-counts")
    if buckets is None:
        buckets = min(AUC_BUCKETS[1], max(AUC_BUCKETS[0], -(-g.count() // AUC_BUCKET)))
    probs = [i / buckets for i in range(1, max(buckets, 2))]
    bounds = sorted(set(g.select(F.percentile_approx("s", probs, 10000)).first()[0] or [0.0]))
    # bucket i holds scores in (bounds[i-1], bounds[i]]
    b = g.select("*", _bucket_of(F.col("s"), bounds).alias("bucket"))
    totals = dict(b.groupBy("bucket").agg(F.sum("neg").alias("n")).collect())
    offsets, run = [], 0
    for i in range(len(bounds) + 1):
        offsets.append((i, run))
        run += int(totals.get(i, 0) or 0)
    before = F.broadcast(df.sparkSession.createDataFrame(offsets, "bucket int, below long"))
    within = F.coalesce(F.sum("neg").over(Window.partitionBy("bucket").orderBy("s")
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (b.withColumn("within", within).join(before, "bucket")
              .select("pos", "neg", (F.col("below") + F.col("within")).alias("neg_below")))
    return ranked.agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def exact_auc_by(df: DataFrame, by: list[str], score_col: str, label_col: str,
                 buckets: int | None = None) -> DataFrame:
    """``exact_auc`` per group of ``by`` (non-null columns): ``by``, auc, positives,
    negatives.  Scores of all groups share their buckets, so a group that holds
    most rows is sorted in as many tasks as its scores fill."""
    g = (df.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull())
           .groupBy(*by, F.col(score_col).cast("double").alias("s"))
           .agg(F.count(F.when(F.col(label_col) == 1, 1)).alias("pos"),
                F.count(F.when(F.col(label_col) != 1, 1)).alias("neg")))
    g = _written(g, "score-counts")
    if buckets is None:
        buckets = min(AUC_BUCKETS[1], max(AUC_BUCKETS[0], -(-g.count() // AUC_BUCKET)))
    probs = [i / buckets for i in range(1, max(buckets, 2))]
    bounds = sorted(set(g.select(F.percentile_approx("s", probs, 10000)).first()[0] or [0.0]))
    b = g.select("*", _bucket_of(F.col("s"), bounds).alias("bucket"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (b.groupBy(*by, "bucket").agg(F.sum("neg").alias("n"))  # at most `buckets` rows a group
              .select(*by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below")))
    inside = Window.partitionBy(*by, "bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (b.withColumn("within", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(totals, [*by, "bucket"]))
    neg_below = F.col("below") + F.col("within")
    return ranked.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("pos") * (neg_below + F.col("neg") / 2.0)),
                     F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))


def _bucket_of(score, bounds: list[float]):
    """Place of ``score`` among the sorted bounds (equal: the lower bucket), as a
    balanced CASE tree."""
    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(score <= F.lit(float(bounds[mid])), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(bounds)).cast("int")
