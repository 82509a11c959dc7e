"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from redeemflow.session import ensure_checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder now.

    Survives lost executors (the files are not executor-local) and makes a
    table that several later steps read be computed once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder, read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage of a large table: write it as Parquet (compressed, by column) in
    the shared checkpoint folder and read it again.

    The shuffle files behind it are then of no use; Spark deletes them once the
    driver has collected the plan that made them, so that is asked for here
    (after a moment in which Spark's listeners let go of the plan).
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.parquet(path)
    del df
    for _ in range(2):
        time.sleep(1)
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def fold(parts: DataFrame, merge, schema: str) -> DataFrame:
    """One row from many bounded summaries: first those of each shuffle partition are
    merged, then what that gives.

    ``merge`` takes an iterator of Arrow batches and yields batches of the same
    schema, at most one row; it must be associative.  No row where ``parts`` has none.
    """
    part = parts.withColumn("_part", F.spark_partition_id()).repartition("_part").drop("_part")
    return part.mapInArrow(merge, schema).repartition(1).mapInArrow(merge, schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of an undirected edge list.

    ``edges`` has columns ``u`` and ``v`` (any orderable type).  Returns
    ``node, component`` with one row per distinct non-null node that has an
    edge to another node; self loops and nulls add nothing.

    Alternates large-star and small-star rounds until the edge list stops
    changing.  A round aggregates each node's smallest neighbour (with map-side
    combine, so a hub's neighbours are never a list) and joins that one value back:
    there a hub's edges share a partition, which AQE's skew join splits.  The edge list
    never grows past its first size.  Each round is checkpointed in the shared folder.
    """
    def star(sym: DataFrame) -> DataFrame:
        low = sym.groupBy("u").agg(F.min("v").alias("m"))
        return low.select("u", F.least("u", "m").alias("m"))

    e = cut(edges.where("u is not null and v is not null and u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        # large star: neighbours above u move to u's smallest neighbour
        sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = (sym.join(star(sym), "u").where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its lower neighbours move to the lowest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(e.join(low, "u")
                .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                          F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                .select("x.u", "x.v").where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
