"""Coupon log sources and sinks.

The log has one row per coupon receipt or purchase:

    user_id, merchant_id, coupon_id?, discount_rate?, distance?,
    date_received?, date?

``coupon_id`` null marks a purchase without a coupon, ``date`` null a
receipt that was never used.  Raw files carry dates as ``yyyyMMdd`` text
and missing values as the literal ``null``; readers turn both into typed
Spark columns so every later operator works on DATE / LONG / INT.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("coupon_id", T.LongType()),
    T.StructField("discount_rate", T.StringType()),
    T.StructField("distance", T.IntegerType()),
    T.StructField("date_received", T.DateType()),
    T.StructField("date", T.DateType()),
])

TEST_LOG_SCHEMA = T.StructType([f for f in LOG_SCHEMA.fields if f.name != "date"])

# The online log: loaded by the reference, never used by any feature.
ONLINE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("action", T.IntegerType()),
    T.StructField("coupon_id", T.StringType()),
    T.StructField("discount_rate", T.StringType()),
    T.StructField("date_received", T.DateType()),
    T.StructField("date", T.DateType()),
])

def _typed(raw: DataFrame, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    cols = list(keep)
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            # float-formatted dates ("20160528.0") appear in headered files
            c = F.try_to_date(F.regexp_replace(c, r"\.0+$", ""), "yyyyMMdd")
        elif isinstance(f.dataType, (T.LongType, T.IntegerType)):
            c = F.regexp_replace(c, r"\.0+$", "").try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def read_log_csv(spark: SparkSession, path: str, header: bool = True,
                 with_date: bool = True, sep: str = ",") -> DataFrame:
    """Read a raw log file (S1 headered, S2 headerless by position).

    The tokens ``null``, ``NaN`` and the empty string become SQL null.
    Text is read first and typed afterwards, so ``yyyyMMdd`` and
    ``yyyyMMdd.0`` both parse.
    """
    schema = LOG_SCHEMA if with_date else TEST_LOG_SCHEMA
    return _typed(_raw_log(spark, path, header, with_date, sep), schema)


def _raw_log(spark: SparkSession, path: str, header: bool, with_date: bool, sep: str) -> DataFrame:
    schema = LOG_SCHEMA if with_date else TEST_LOG_SCHEMA
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(raw_schema)
           .option("header", header)
           .option("sep", sep)
           .option("nullValue", "null")
           .option("nanValue", "NaN")
           .option("enforceSchema", True)
           .csv(path))
    return raw.select(*[F.when(F.col(c).isin("", "nan", "NaN"), None).otherwise(F.col(c)).alias(c)
                        for c in raw.columns])


def malformed(spark: SparkSession, path: str, header: bool = True, with_date: bool = True,
              sep: str = ",") -> DataFrame:
    """Counts of cells, per column, that hold text which is no id, number or date
    (``column_name, cells``).  ``read_log_csv`` turns those into nulls, and a null
    coupon means a purchase without one, so a count above zero wants a look."""
    raw = _raw_log(spark, path, header, with_date, sep)
    schema = LOG_SCHEMA if with_date else TEST_LOG_SCHEMA
    typed = _typed(raw.select("*", F.struct(*raw.columns).alias("_raw")), schema, keep=["_raw"])
    counts = typed.agg(*[F.count(F.when(F.col(f"_raw.{f.name}").isNotNull() & F.col(f.name).isNull(), 1)).alias(f.name)
                         for f in schema.fields])
    return counts.unpivot([], [f.name for f in schema.fields], "column_name", "cells")


def read_log_checked(spark: SparkSession, path: str, header: bool = True, with_date: bool = True, sep: str = ",",
                     strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read a raw log file into rows that are what they should be and lines that are not.

    The first result has the rows of ``read_log_csv`` without those of rejected lines; the
    second has ``file, line, reason`` of every rejected line.  Together they are the lines of
    the files (a header, which holds the columns' names in any case, is none).  A line
    is rejected for another number of cells (``columns``, alone), for a cell that is no id,
    number or date (``<column>``), and for a missing user or merchant (``no <column>``); reasons
    are joined by commas in column order.  With ``strict`` the first result raises at the
    first such line instead.
    """
    schema = LOG_SCHEMA if with_date else TEST_LOG_SCHEMA
    names = schema.fieldNames()
    raw = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("_bad", T.StringType())])
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    if header:
        lines = lines.where(F.lower("line") != sep.join(names))
    lines = lines.where("trim(line) <> ''")
    options = {"sep": sep, "nullValue": "null", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_csv("line", raw.simpleString()[len("struct<"):-1].replace(":", " "), options)
    # unpacked by a generator, through which no filter is pushed: a filter on the cells would
    # parse the line again for every mention of one
    cells = lines.select("file", "line", F.inline(F.array(parsed)))
    cells = cells.select("file", "line", "_bad", *[
        F.when(F.col(n).isin("", "nan", "NaN"), None).otherwise(F.col(n)).alias(n) for n in names])
    typed = _typed(cells.select("*", F.struct(*names).alias("_raw")), schema, keep=["file", "line", "_bad", "_raw"])
    reasons = []
    for f in schema.fields:
        reasons.append(F.when(F.col(f"_raw.{f.name}").isNotNull() & F.col(f.name).isNull(), f.name))
        if f.name in ("user_id", "merchant_id"):
            reasons.append(F.when(F.col(f"_raw.{f.name}").isNull(), f"no {f.name}"))
    reason = F.when(F.col("_bad").isNotNull(), "columns").otherwise(F.array_join(F.array_compact(F.array(*reasons)), ","))
    judged = typed.select(*names, "file", "line", reason.alias("reason"))
    rejected = judged.where("reason <> ''").select("file", "line", "reason")
    if strict:
        told = F.raise_error(F.concat(F.lit("rejected line ("), "reason", F.lit("): "), "line")).cast("boolean")
        return judged.where(F.when(F.col("reason") == "", True).otherwise(told)).select(*names), rejected
    return judged.where("reason = ''").select(*names), rejected


def write_by_day(df: DataFrame, path: str, day: str | Column) -> None:
    """Write rows into a folder per day (E12 and S6 as one table that grows by days).  Days that
    ``df`` has replace what the table holds of them; other days stay as they are, so a day
    can be written again.  A busy day is split over tasks by its users."""
    day = F.col(day) if isinstance(day, str) else day
    (df.withColumn("day", day).repartitionByRange("day", F.col(df.columns[0]))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_by_day(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A table of ``write_by_day``, or its days from ``first`` to ``last``: only their folders
    are read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
    return rows.drop("day")


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Hand a block over as a table dealt into buckets by its keys and sorted in them (S4):
    tables of the same keys and number of buckets are joined without moving a row.  One
    file per bucket; ``path`` lies in shared storage.  Returns the table."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
       .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name))
    return spark.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """The table that another session handed over."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def read_online_csv(spark: SparkSession, path: str, header: bool = False,
                    sep: str = ",") -> DataFrame:
    """S3: the online log (with ``action``).  The reference loads it and never
    uses it; it is offered as a typed source only."""
    raw_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in ONLINE_SCHEMA.fields])
    raw = (spark.read.schema(raw_schema).option("header", header).option("sep", sep)
           .option("nullValue", "null").csv(path))
    return _typed(raw, ONLINE_SCHEMA)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Write CSV with or without header; dates as yyyyMMdd, nulls as ``null``."""
    out = df.select(*[
        F.date_format(F.col(f.name), "yyyyMMdd").alias(f.name)
        if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields])
    (out.write.mode(mode)
        .option("header", header)
        .option("nullValue", "null")
        .csv(path))


def read_matrix_csv(spark: SparkSession, path: str, n_cols: int, sep: str = "\t") -> DataFrame:
    """A delimited numeric matrix -> (row_id, features array<double>).

    A line that has no number where one is due fails the job (empty lines are
    no rows).  ``row_id`` numbers the lines by file, block and place: unique, and
    the same as long as the files and the split size are.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.DoubleType()) for i in range(n_cols)])
    df = (spark.read.schema(schema).option("sep", sep).option("mode", "FAILFAST")
          .option("enforceSchema", True).csv(path))
    cells = [F.coalesce(F.col(f"c{i}"), F.raise_error(F.lit(f"column {i} of a matrix line is empty")).cast("double"))
             for i in range(n_cols)]
    return df.select(F.monotonically_increasing_id().alias("row_id"), F.array(*cells).alias("features"))


def _d(days: Column) -> Column:
    return F.date_add(F.lit("2016-01-01").cast("date"), days.cast("int"))


def coupon_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``coupon`` view: a coupon log derived from lineitem x orders.

    Fixed mapping (must match the oracle SQL text in plans/sql.py):
    user = o_custkey, merchant = l_suppkey % 25, coupon = l_partkey % 50
    (none when l_linenumber = 7), distance = int(l_quantity) % 11 (none
    when (l_orderkey + l_linenumber) % 9 = 0), receive day offset =
    days(o_orderdate - 1995-01-01) % 213 from 2016-01-01, consume gap =
    (l_orderkey + l_partkey) % 31, used when
    (l_orderkey + 3 * l_linenumber + l_partkey) % 4 = 0.
    The five discount texts by coupon % 5: 0.95, 30:5, 100:10, 20:5, 200:20.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    b = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        (F.col("l_suppkey") % 25).alias("merchant_id"),
        F.when(F.col("l_linenumber") == 7, None)
         .otherwise(F.col("l_partkey") % 50).alias("coupon_id"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 9 == 0, None)
         .otherwise(F.col("l_quantity").cast("int") % 11).alias("distance"),
        (F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) % 213)
        .alias("off"),
        ((F.col("l_orderkey") + F.col("l_partkey")) % 31).alias("gap"),
        (F.col("l_linenumber") == 7).alias("plain"),
        ((F.col("l_orderkey") + 3 * F.col("l_linenumber") + F.col("l_partkey")) % 4 == 0)
        .alias("used"),
    )
    rate = (F.when(F.col("coupon_id") % 5 == 0, "0.95")
             .when(F.col("coupon_id") % 5 == 1, "30:5")
             .when(F.col("coupon_id") % 5 == 2, "100:10")
             .when(F.col("coupon_id") % 5 == 3, "20:5")
             .when(F.col("coupon_id") % 5 == 4, "200:20"))
    return b.select(
        "user_id", "merchant_id", "coupon_id",
        rate.alias("discount_rate"),
        "distance",
        F.when(F.col("plain"), None).otherwise(_d(F.col("off"))).alias("date_received"),
        F.when(F.col("plain"), _d(F.col("off")))
         .when(F.col("used"), _d(F.col("off") + F.col("gap"))).alias("date"),
    )


def _fs_size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def _fs_stamp(spark: SparkSession, path: str) -> str:
    """Size and modification time of a file or folder (Hadoop FS, so it works
    on any cluster file system)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    st = fs.getFileStatus(p)
    return f"{fs.getContentSummary(p).getLength()}-{st.getModificationTime()}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _rename(spark: SparkSession, src: str, dst: str) -> bool:
    jvm = spark.sparkContext._jvm
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    return s.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(s, d)


def log_table_path(spark: SparkSession, sf_dir: str) -> str:
    """Where the materialised log of ``sf_dir`` lives: under the shared
    storage root (the same in every session), keyed by the input tables'
    sizes and mtimes."""
    from redeemflow.session import storage_root

    key = hashlib.sha1("|".join([
        os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir,
        _fs_stamp(spark, f"{sf_dir}/lineitem.parquet"),
        _fs_stamp(spark, f"{sf_dir}/orders.parquet")]).encode()).hexdigest()[:16]
    return f"{storage_root(spark)}/coupon_log-{key}"


def materialize_log(spark: SparkSession, sf_dir: str) -> str:
    """Ingest: write the log once as Parquet, globally ordered by day, so
    every later job reads it with the date ranges of its splits pushed into
    the scan (row-group min/max skipping).  The write goes to a
    unique folder that is renamed into place, so a failed or concurrent
    attempt never leaves a half-written table behind."""
    final = log_table_path(spark, sf_dir)
    if _exists(spark, f"{final}/_SUCCESS"):
        return final
    # Order by the row's own day (receipt day, else purchase day), then user:
    # receipts without a purchase and purchases without a coupon both get a
    # real key (a null key would send every plain purchase to one task), and
    # the user column lets the range partitioner split a very busy day.
    day = F.coalesce(F.col("date_received"), F.col("date"))
    # An explicit file count (AQE would otherwise coalesce a small table
    # into one file, and every later scan into one task): one file per
    # 128 MB of input, and at least one per core of the cluster.
    in_bytes = sum(_fs_size(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders"))
    files = max(spark.sparkContext.defaultParallelism, -(-in_bytes // (128 << 20)))
    publish(coupon_view(spark, sf_dir)
            .repartitionByRange(files, day, F.col("user_id"))
            .sortWithinPartitions(day, "user_id"), final)
    return final


def publish(df: DataFrame, final: str) -> None:
    """Write ``df`` as Parquet to a folder of its own and rename that to ``final``.  Where
    another job was first, its table stays."""
    spark, tmp = df.sparkSession, f"{final}.tmp-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").parquet(tmp)
    if not _rename(spark, tmp, final) and not _exists(spark, f"{final}/_SUCCESS"):
        raise RuntimeError(f"could not publish {final}")


def stored_table(spark: SparkSession, path: str, source: str, order: list[str], make) -> DataFrame:
    """The table at ``path``, made and published first if it is not there: ordered by the
    columns ``order``, in a file per 8 MB of ``source`` (the table it is made from, compressed
    well: some million rows) and at least one per core.  ``make`` takes that number and returns
    rows dealt into so many ranges of ``order``, so what it aggregates by these columns and
    others moves once."""
    if not _exists(spark, f"{path}/_SUCCESS"):
        files = max(spark.sparkContext.defaultParallelism, -(-_fs_size(spark, source) // (8 << 20)))
        publish(make(files).sortWithinPartitions(*order), path)
    return spark.read.parquet(path)


def coupon_log(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """The log every query reads.  By default the stored copy written by
    ``materialize_log`` (same rows and schema as ``coupon_view``)."""
    if not materialized:
        return coupon_view(spark, sf_dir)
    return spark.read.schema(LOG_SCHEMA).parquet(materialize_log(spark, sf_dir))


# The offline train log is every row up to the end of June; the test log is
# the July receipts, without ``date`` (the reference's test file has none).
TEST_START = "2016-07-01"
TEST_END = "2016-08-01"


def offline_test(log: DataFrame) -> DataFrame:
    return (log.where((F.col("date_received") >= F.lit(TEST_START).cast("date"))
                      & (F.col("date_received") < F.lit(TEST_END).cast("date")))
               .drop("date"))
