"""Incremental ingest of raw log files with Structured Streaming.

The reference has no streaming operator; its only source is a batch of
log CSV files.  When new daily files keep arriving, the same typed reader
runs as a stateless streaming query: each micro-batch of new files is
parsed (``null`` tokens -> SQL null, ``yyyyMMdd`` -> DATE) and appended to
a Parquet log table.  The query's checkpoint lies below a folder that is the
same in every session (``root``, else ``spark.checkpoint.dir``), so a job that
starts again goes on after the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from redeemflow.session import storage_root
from redeemflow.sources.log import LOG_SCHEMA, TEST_LOG_SCHEMA, _typed


def log_stream(spark: SparkSession, src_dir: str, header: bool = False,
               with_date: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame over the log files appearing in ``src_dir``."""
    schema = LOG_SCHEMA if with_date else TEST_LOG_SCHEMA
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = (spark.readStream.schema(raw_schema)
              .option("header", header)
              .option("nullValue", "null"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(src_dir)
    raw = raw.select(*[F.when(F.col(c).isin("", "nan", "NaN"), None).otherwise(F.col(c)).alias(c)
                       for c in raw.columns])
    return _typed(raw, schema)


def ingest(spark: SparkSession, src_dir: str, table_dir: str, name: str = "log-ingest",
           header: bool = False, with_date: bool = True, root: str | None = None) -> StreamingQuery:
    """Append every new file of ``src_dir`` to the Parquet table at
    ``table_dir`` (trigger ``availableNow``: process what is there, stop).

    The checkpoint is ``<root>/stream-<name>``.  ``root`` has to outlive the
    session: without it and without ``spark.checkpoint.dir`` this raises, because a
    new checkpoint beside an old table would skip new files."""
    if root is None:
        if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
            raise ValueError("name a lasting root, or set spark.checkpoint.dir")
        root = storage_root(spark)
    ckpt = f"{root.rstrip('/')}/stream-{name}"
    return (log_stream(spark, src_dir, header, with_date)
            .writeStream.format("parquet")
            .option("path", table_dir)
            .option("checkpointLocation", ckpt)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())
