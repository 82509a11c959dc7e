"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on.  AQE re-plans joins from measured
# shuffle sizes (runtime broadcast, skew-join splitting, partition
# coalescing); the session time zone is pinned so date casts are stable.
# Cluster-provided values win: only keys the session has not set are applied.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    # No broadcast from plan-time estimates; AQE broadcasts a join side only
    # after its shuffle has run and its measured size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffles to the advisory size (64 MB), not to maximum
    # parallelism: fewer, fuller tasks (Spark's advice for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "redeemflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # the UI is a server; it must be off before the context starts
    builder = builder.config("spark.ui.enabled", "false")
    # checkpoint files of plans that nobody holds any more go with them
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    given = spark.sparkContext.getConf()
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        if k == "spark.ui.enabled" or (given.contains(k) and k not in (extra or {})
                                       and k != "spark.sql.shuffle.partitions"):
            continue
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def storage_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    The same in every session of one setting, so tables and stream
    checkpoints below it are found again after a restart.  Unset, a private
    folder takes its place on a local master (as in tests); anywhere else that
    is an error, since executors would not share it.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    current = sc.getCheckpointDir()
    if current:  # set by the caller: Spark appends a folder per session
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="redeemflow-ckpt-")
    sc.setCheckpointDir(path)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return this session's checkpoint folder, below ``storage_root``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = storage_root(spark)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under this session's checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def remove_scratch(spark: SparkSession) -> None:
    """Delete this session's checkpoint folder: the intermediate tables and lineage cuts of all
    its queries.  For the end of a job, when its results are written elsewhere; the
    ingested log and the day-grain tables, which lie beside that folder, stay."""
    path = spark.sparkContext.getCheckpointDir()
    if path:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def apply_conf(spark: SparkSession) -> None:
    """The settings that query results rest on, for sessions built elsewhere:
    dates and weekdays are cast in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
