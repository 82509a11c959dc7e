"""The query registry: one Spark plan and (where SQL can say it) one DuckDB
oracle per operator of the inventory.

Every query reads the driver tables of one scale-factor folder through the
``coupon`` view, over whole tables.  Doubles are rounded to 6 places and
integer outputs carry the same type on both sides, so the checker can hash
values.  Intervals (all 2016):

    TH / TL   Family B train history [03-02, 05-01) / label [05-16, 06-16)
    A2d / A2f Family A set 2 dataset 05-15..06-15 / features 02-01..05-14
    A3d / A3f the July test table / features 03-15..06-30
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from redeemflow import functions as RF
from redeemflow.operators import blocks_a as A
from redeemflow.operators import blocks_b as B
from redeemflow.operators import daybits, daygrain, eda, kmeans, median, ml, prep, split
from redeemflow.operators.receipts import date_list_text, date_lists, day_gaps, first_last_flags, pair_day_stats
from redeemflow.plans import assemble
from redeemflow.plans import sql as S
from redeemflow.session import apply_conf, scratch_path
from redeemflow.sources import (coupon_log, log_table_path, malformed, offline_test, read_by_day, read_log_checked,
                                read_log_csv, read_matrix_csv, read_online_csv, stored_table, write_bucketed, write_by_day,
                                write_csv)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to 6 places."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def log(spark, d) -> DataFrame:
    apply_conf(spark)
    return coupon_log(spark, d)


def _grain(spark, d, family: str, make) -> DataFrame:
    """The stored day-grain partials of a family: written once per input, like the log."""
    lg, path = log(spark, d), log_table_path(spark, d)
    return stored_table(spark, f"{path}-grain-{family}", path, ["day", "user_id"], lambda files: make(lg, files))


def a_grain(spark, d) -> DataFrame:
    return _grain(spark, d, "day-a", daygrain.a_grain)


def b_grain(spark, d) -> DataFrame:
    return _grain(spark, d, "day-b", lambda lg, files: daygrain.b_grain(prep.prepare_b(lg), files))


def tl(spark, d) -> DataFrame:
    return split.half_open(prep.prepare_b(log(spark, d)), "date_received", "2016-05-16", 31)


def th(spark, d) -> DataFrame:
    return split.half_open(prep.prepare_b(log(spark, d)), "date_received", "2016-03-02", 60)


def a2(spark, d):
    return split.a_fields(log(spark, d), 2)


TL_W = S.half_open("date_received", "2016-05-16", "2016-06-16")
TH_W = S.half_open("date_received", "2016-03-02", "2016-05-01")
A2D_W = S.between("date_received", "2016-05-15", "2016-06-15")
A2F_W = S.between("COALESCE(date, date_received)", "2016-02-01", "2016-05-14")
A3F_W = S.between("COALESCE(date, date_received)", "2016-03-15", "2016-06-30")
PB = f"pb AS ({S.prep_b('coupon')})"
TL_CTE = f"tl AS (SELECT * FROM pb WHERE {TL_W})"
TH_CTE = f"th AS (SELECT * FROM pb WHERE {TH_W})"


# ====================================================================== sources
@register("src_csv_roundtrip", S.with_() + "SELECT * FROM coupon")
def q_src_csv_roundtrip(spark, d):
    """Write the log as headered CSV (dates yyyyMMdd, nulls as
    ``null``) to the shared scratch folder and read it back typed."""
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(log(spark, d), path, header=True)
    return read_log_csv(spark, path, header=True)


@register("src_csv_headerless", S.with_() + "SELECT * FROM coupon")
def q_src_csv_headerless(spark, d):
    """The same by position, without a header."""
    path = scratch_path(spark, "csv-headerless")
    write_csv(log(spark, d), path, header=False)
    return read_log_csv(spark, path, header=False)


@register("src_malformed", S.with_() + "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({n} AS BIGINT) AS cells" for c, n in (
        ("user_id", 0), ("merchant_id", 0), ("coupon_id", "(SELECT COUNT(*) FROM coupon WHERE coupon_id % 7 = 0)"),
        ("discount_rate", 0), ("distance", 0), ("date_received", 0), ("date", 0))) + ")")
def q_src_malformed(spark, d):
    """Cells that are no id, number or date: every coupon divisible by 7 is
    written with a letter and has to be reported."""
    path = scratch_path(spark, "csv-malformed")
    bad = F.when(F.col("coupon_id") % 7 == 0, F.concat(F.lit("x"), "coupon_id")).otherwise(
        F.col("coupon_id").cast("string"))
    write_csv(log(spark, d).withColumn("coupon_id", bad), path, header=True)
    return malformed(spark, path, header=True)


_BAD_COUPON, _BAD_DATE = "coupon_id % 7 = 0", "merchant_id = 3 AND date_received IS NOT NULL"


@register("src_quarantine", S.with_() + f"""SELECT CASE WHEN reason = '' THEN 'good' ELSE 'rejected' END AS status, reason,
  COUNT(*) AS rows, CAST(SUM(user_id) AS BIGINT) AS users FROM (SELECT user_id, CASE WHEN user_id % 13 = 0 THEN 'columns'
    WHEN COALESCE({_BAD_COUPON}, FALSE) AND {_BAD_DATE} THEN 'coupon_id,date_received' WHEN {_BAD_COUPON} THEN 'coupon_id'
    WHEN {_BAD_DATE} THEN 'date_received' ELSE '' END AS reason FROM coupon) GROUP BY ALL""")
def q_src_quarantine(spark, d):
    """S1 with a quarantine: the log written with a cell too many in some lines, letters in
    some coupons and a day that is none in some dates; every line is a row or is rejected
    with its reasons."""
    path = scratch_path(spark, "csv-quarantine")
    bad = {"coupon_id": F.when(F.expr(_BAD_COUPON), F.concat(F.lit("x"), "coupon_id")),
           "date_received": F.when(F.expr(_BAD_DATE), F.lit("20161345"))}
    rows = log(spark, d)
    cells = [F.coalesce(bad.get(c, F.lit(None)), F.date_format(c, "yyyyMMdd") if c.startswith("date") else F.col(c).cast("string"),
                        F.lit("null")) for c in rows.columns]
    line = F.concat_ws(",", *cells, F.when(F.col("user_id") % 13 == 0, "9"))
    rows.select(line.alias("value")).write.text(path)
    good, rejected = read_log_checked(spark, path, header=False)
    user = F.split("line", ",")[0].cast("long")
    both = good.select(F.lit("good").alias("status"), F.lit("").alias("reason"), "user_id").unionByName(
        rejected.select(F.lit("rejected").alias("status"), "reason", user.alias("user_id")))
    return both.groupBy("status", "reason").agg(F.count("*").alias("rows"), F.sum("user_id").alias("users"))


@register("src_online", S.with_() + """SELECT user_id, merchant_id, CAST(CASE WHEN coupon_id IS NULL THEN 1 ELSE 2 END AS INTEGER) AS action,
  CASE WHEN coupon_id % 10 = 0 THEN 'fixed' ELSE CAST(coupon_id AS VARCHAR) END AS coupon_id, discount_rate, date_received, date FROM coupon""")
def q_src_online(spark, d):
    """S3: the online log's layout (an action, coupon ids as text), written and read typed."""
    path = scratch_path(spark, "csv-online")
    rows = log(spark, d).select(
        "user_id", "merchant_id", F.when(F.col("coupon_id").isNull(), 1).otherwise(2).alias("action"),
        F.when(F.col("coupon_id") % 10 == 0, "fixed").otherwise(F.col("coupon_id").cast("string")).alias("coupon_id"),
        "discount_rate", "date_received", "date")
    write_csv(rows, path, header=False)
    return read_online_csv(spark, path)


# ====================================================================== row level
@register("prep_discount", S.with_() + f"""SELECT user_id, merchant_id, coupon_id, discount_rate,
  {S.is_manjian()} AS is_manjian, round({S.ratio_b()}, 6) AS rate_b,
  round({S.ratio_a()}, 6) AS rate_a, {S.min_cost()} AS min_cost_of_manjian,
  {S.man()} AS discount_man, {S.jian()} AS discount_jian FROM coupon""")
def q_prep_discount(spark, d):
    df = log(spark, d).select("user_id", "merchant_id", "coupon_id", "discount_rate",
                              *RF.discount_parts())
    return r6(df.select("user_id", "merchant_id", "coupon_id", "discount_rate",
                        RF.p_is_manjian().alias("is_manjian"),
                        RF.p_ratio("discount_rate", "b").alias("rate_b"),
                        RF.p_ratio("discount_rate", "a").alias("rate_a"),
                        RF.p_min_cost().alias("min_cost_of_manjian"),
                        RF.p_man().alias("discount_man"),
                        RF.p_jian().alias("discount_jian")))


@register("prep_distance", S.with_() + """SELECT user_id, merchant_id, coupon_id, date_received,
  distance, COALESCE(distance, -1) AS distance_filled,
  CAST(distance IS NULL AS INTEGER) AS null_distance FROM coupon""")
def q_prep_distance(spark, d):
    df = prep.with_distance(log(spark, d))
    return df.select("user_id", "merchant_id", "coupon_id", "date_received", "distance",
                     "distance_filled", "null_distance")


@register("prep_dates", S.with_() + f"""SELECT user_id, coupon_id, date_received, date,
  {S.isodow('date_received')} AS weekday_received, {S.month('date_received')} AS month_received,
  {S.month('date')} AS month_consumed, {S.days('date', 'date_received')} AS days_to_use
  FROM coupon""")
def q_prep_dates(spark, d):
    df = prep.with_dates(log(spark, d))
    return df.select("user_id", "coupon_id", "date_received", "date", "weekday_received",
                     "month_received", "month_consumed",
                     RF.day_gap("date", "date_received").alias("days_to_use"))


@register("prep_all", S.with_() + f"""SELECT *, {S.is_manjian()} AS is_manjian,
  round({S.ratio_b()}, 6) AS discount_ratio, {S.min_cost()} AS min_cost_of_manjian,
  COALESCE(distance, -1) AS distance_filled, CAST(distance IS NULL AS INTEGER) AS null_distance,
  {S.isodow('date_received')} AS weekday_received, {S.month('date_received')} AS month_received,
  {S.days('date', 'date_received')} AS days_to_use, {S.month('date')} AS month_consumed,
  {S.label_b()} AS label FROM coupon""")
def q_prep_all(spark, d):
    return r6(prep.prep_all(log(spark, d)))


@register("prep_by_day", ORACLE["prep_all"])
def q_prep_by_day(spark, d):
    """E12 and S6 as a table by day: all days written, three of them a second time, which
    changes nothing."""
    path = scratch_path(spark, "prepared-by-day")
    prepared = prep.prep_all(log(spark, d))
    day = F.coalesce("date_received", "date")
    write_by_day(prepared, path, day)
    write_by_day(prepared.where(day.between(RF.lit_date("2016-05-15"), RF.lit_date("2016-05-17"))), path, day)
    return r6(read_by_day(spark, path))


_ONEHOT_SQL = ", ".join(
    f"CAST(COALESCE(distance, -1) = {v} AS INTEGER) AS distance_{'neg1' if v < 0 else v}"
    for v in prep.DISTANCE_DOMAIN)


@register("onehot_distance", S.with_() + f"""SELECT user_id, coupon_id, distance, {_ONEHOT_SQL}
  FROM coupon""")
def q_onehot_distance(spark, d):
    df = prep.onehot_distance(log(spark, d).select("user_id", "coupon_id", "distance"))
    return df


@register("label_binary", S.with_() + f"""SELECT user_id, coupon_id, date_received, date,
  {S.label_b()} AS label FROM coupon WHERE {TL_W}""")
def q_label_binary(spark, d):
    df = split.half_open(log(spark, d), "date_received", "2016-05-16", 31)
    return df.select("user_id", "coupon_id", "date_received", "date",
                     RF.label_binary().alias("label"))


@register("label_threeway", S.with_() + f"""SELECT user_id, coupon_id, date_received, date,
  {S.label_a()} AS label,
  CASE WHEN {S.label_a()} = -1 THEN 0 ELSE {S.label_a()} END AS label_train
  FROM coupon WHERE {A2D_W}""")
def q_label_threeway(spark, d):
    data, _ = a2(spark, d)
    df = data.select("user_id", "coupon_id", "date_received", "date",
                     RF.label_threeway().alias("label"))
    return df.select("*", RF.label_for_training("label").alias("label_train"))


def _split_rows(spark, d, family: str) -> DataFrame:
    """One pass over the log: each row is tagged with every split it falls
    in (with that split's date), then one grouped aggregate."""
    lg = log(spark, d)
    tags = []
    if family == "b":
        for name, s in split.B_SPLITS.items():
            for part, col, rng in (("history", "date_received", s.history),
                                   ("middle", "date", s.middle),
                                   ("label", "date_received", s.label)):
                if rng is None:
                    cond = ((F.col("date_received") >= RF.lit_date(split.TEST_START))
                            & (F.col("date_received") < RF.lit_date(split.TEST_END)))
                    col = "date_received"
                else:
                    start, n = rng
                    end = split._plus(start, n)
                    cond = (F.col(col) >= RF.lit_date(start)) & (F.col(col) < RF.lit_date(end))
                tags.append(F.when(cond, F.struct(F.lit(f"{name}_{part}").alias("split"),
                                                  F.col(col).alias("day"))))
    else:
        for n, s in split.A_SETS.items():
            if s.data is None:
                cond = ((F.col("date_received") >= RF.lit_date(split.TEST_START))
                        & (F.col("date_received") < RF.lit_date(split.TEST_END)))
            else:
                cond = F.col("date_received").between(RF.lit_date(s.data[0]), RF.lit_date(s.data[1]))
            tags.append(F.when(cond, F.struct(F.lit(f"set{n}_dataset").alias("split"),
                                              F.col("date_received").alias("day"))))
            eff = F.coalesce(F.col("date"), F.col("date_received"))
            fcond = eff.between(RF.lit_date(s.features[0]), RF.lit_date(s.features[1]))
            tags.append(F.when(fcond, F.struct(F.lit(f"set{n}_features").alias("split"),
                                               eff.alias("day"))))
    ex = lg.select(F.explode(F.filter(F.array(*tags), lambda x: x.isNotNull())).alias("t"))
    return (ex.groupBy(F.col("t.split").alias("split"))
              .agg(F.count(F.lit(1)).alias("rows"), F.min("t.day").alias("first_day"),
                   F.max("t.day").alias("last_day")))


# The reference's own dates, written out: (split, column or expression, first
# day, last day).
_B_DATES = [
    ("train_history", "date_received", "2016-03-02", "2016-04-30"),
    ("train_middle", "date", "2016-05-01", "2016-05-15"),
    ("train_label", "date_received", "2016-05-16", "2016-06-15"),
    ("validate_history", "date_received", "2016-01-16", "2016-03-15"),
    ("validate_middle", "date", "2016-03-16", "2016-03-30"),
    ("validate_label", "date_received", "2016-03-31", "2016-04-30"),
    ("test_history", "date_received", "2016-04-17", "2016-06-15"),
    ("test_middle", "date", "2016-06-16", "2016-06-30"),
    ("test_label", "date_received", "2016-07-01", "2016-07-31"),
]
_A_DATES = [
    ("set1_dataset", "date_received", "2016-04-14", "2016-05-14"),
    ("set1_features", "COALESCE(date, date_received)", "2016-01-01", "2016-04-13"),
    ("set2_dataset", "date_received", "2016-05-15", "2016-06-15"),
    ("set2_features", "COALESCE(date, date_received)", "2016-02-01", "2016-05-14"),
    ("set3_dataset", "date_received", "2016-07-01", "2016-07-31"),
    ("set3_features", "COALESCE(date, date_received)", "2016-03-15", "2016-06-30"),
]


def _split_sql(dates) -> str:
    return S.with_() + "SELECT * FROM (" + "\nUNION ALL ".join(
        f"SELECT '{name}' AS split, COUNT(*) AS rows, MIN({day}) AS first_day, MAX({day}) AS last_day "
        f"FROM coupon WHERE {day} >= DATE '{first}' AND {day} <= DATE '{last}'"
        for name, day, first, last in dates) + ") WHERE rows > 0"


@register("split_b", _split_sql(_B_DATES))
def q_split_b(spark, d):
    return _split_rows(spark, d, "b")


@register("split_a", _split_sql(_A_DATES))
def q_split_a(spark, d):
    return _split_rows(spark, d, "a")


# ====================================================================== EDA
@register("eda_profile", S.with_() + """SELECT COUNT(*) AS rows, COUNT(date_received) AS receipts,
  COUNT(date) AS purchases, COUNT(DISTINCT user_id) AS users,
  COUNT(DISTINCT merchant_id) AS merchants, COUNT(DISTINCT coupon_id) AS coupons,
  MIN(date_received) AS first_received, MAX(date_received) AS last_received,
  MIN(date) AS first_used, MAX(date) AS last_used FROM coupon""")
def q_eda_profile(spark, d):
    return eda.profile(log(spark, d))


_MISSING_COLS = ["user_id", "merchant_id", "coupon_id", "discount_rate", "distance",
                 "date_received", "date"]


@register("eda_missing", S.with_() + "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nulls, "
    f"round(CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*), 6) AS share, "
    f"COUNT(*) > COUNT({c}) AS any_null FROM coupon" for c in _MISSING_COLS) + ")")
def q_eda_missing(spark, d):
    return r6(eda.missing(log(spark, d)))


@register("eda_daily", S.with_() + """SELECT date_received, COUNT(coupon_id) AS received,
  MAX(COUNT(coupon_id)) OVER () AS max_received FROM coupon
  WHERE date_received IS NOT NULL GROUP BY date_received""")
def q_eda_daily(spark, d):
    return eda.daily(log(spark, d))


@register("eda_distance", S.with_() + """SELECT distance, COUNT(*) AS rows FROM coupon
  WHERE distance IS NOT NULL GROUP BY distance""")
def q_eda_distance(spark, d):
    return eda.distance_counts(log(spark, d))


@register("eda_distance_rate", S.with_() + f"""SELECT distance, round(AVG({S.label_b()}), 6) AS rate,
  COUNT(*) AS rows, COUNT(*) FILTER (WHERE {S.label_b()} = 1) AS redeemed FROM coupon
  WHERE distance IS NOT NULL GROUP BY distance""")
def q_eda_distance_rate(spark, d):
    return r6(eda.distance_rate(log(spark, d)))


@register("eda_discount", S.with_(f"r AS (SELECT {S.ratio_b()} AS ratio, {S.label_b()} AS label "
                                  f"FROM coupon)") + """SELECT round(ratio, 6) AS ratio,
  COUNT(*) AS received, COUNT(*) FILTER (WHERE label = 1) AS redeemed FROM r
  WHERE ratio IS NOT NULL GROUP BY r.ratio""")
def q_eda_discount(spark, d):
    return r6(eda.discount_counts(log(spark, d)))


@register("eda_month", S.with_(
    f"e AS (SELECT {S.month('date_received')} AS month, CAST(date_received IS NOT NULL AS INTEGER) AS rec, "
    f"CASE WHEN {S.label_b()} = 1 THEN 1 ELSE 0 END AS red, 0 AS con FROM coupon "
    f"UNION ALL SELECT {S.month('date')}, 0, 0, 1 FROM coupon)") + """SELECT month,
  CAST(COALESCE(SUM(red), 0) AS BIGINT) AS redeemed, CAST(COALESCE(SUM(rec), 0) AS BIGINT) AS received,
  CAST(COALESCE(SUM(con), 0) AS BIGINT) AS consumed
  FROM (SELECT CAST(unnest(range(min(month), max(month) + 1)) AS INTEGER) AS month FROM e) axis
    LEFT JOIN e USING (month) GROUP BY month""")
def q_eda_month(spark, d):
    return eda.monthly(log(spark, d))


@register("eda_weekday", S.with_(f"""e AS (SELECT {S.isodow('date_received')} AS weekday, {S.label_b()} AS label
  FROM coupon WHERE date_received IS NOT NULL)""") + """SELECT weekday, COUNT(label) AS received,
  COUNT(*) FILTER (WHERE label = 1) AS redeemed
  FROM (SELECT CAST(unnest([1, 2, 3, 4, 5, 6, 7]) AS INTEGER) AS weekday) axis LEFT JOIN e USING (weekday)
  GROUP BY weekday""")
def q_eda_weekday(spark, d):
    return eda.weekday(log(spark, d))


def _share_sql(value: str, where: str) -> str:
    return S.with_() + f"""SELECT {value} AS v, COUNT(*) AS rows,
  round(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (), 6) AS share FROM coupon
  WHERE {where} GROUP BY 1"""


@register("eda_type_share", _share_sql(S.is_manjian(), "date_received IS NOT NULL")
          .replace(" AS v,", " AS is_manjian,"))
def q_eda_type_share(spark, d):
    return r6(eda.type_share(log(spark, d)))


@register("eda_type_share_redeemed", _share_sql(S.is_manjian(), f"{S.label_b()} = 1")
          .replace(" AS v,", " AS is_manjian,"))
def q_eda_type_share_redeemed(spark, d):
    return r6(eda.type_share(log(spark, d), redeemed_only=True))


@register("eda_label_share", _share_sql(S.label_b(), "TRUE").replace(" AS v,", " AS label,"))
def q_eda_label_share(spark, d):
    return r6(eda.label_share(log(spark, d)))


@register("eda_distance_discount", S.with_(
    f"r AS (SELECT distance, {S.ratio_b()} AS ratio FROM coupon WHERE distance IN (0, 4, 8, 10))")
    + """SELECT distance, round(ratio, 6) AS ratio, COUNT(*) AS rows FROM r
  WHERE ratio IS NOT NULL GROUP BY distance, r.ratio""")
def q_eda_distance_discount(spark, d):
    return r6(eda.distance_discount(log(spark, d)))


_CHART_COLUMNS = {
    "profile": [], "missing": ["column_name"], "daily": ["date_received"], "distance_counts": ["distance"],
    "distance_rate": ["distance"], "discount_counts": ["ratio"], "monthly": ["month"], "weekday": ["weekday"],
    "type_share": ["is_manjian"], "type_share_redeemed": ["is_manjian"], "label_share": ["label"],
    "distance_discount": ["distance", "ratio"]}
_CHART_ORACLE = dict(zip(_CHART_COLUMNS, (
    "eda_profile", "eda_missing", "eda_daily", "eda_distance", "eda_distance_rate", "eda_discount", "eda_month", "eda_weekday",
    "eda_type_share", "eda_type_share_redeemed", "eda_label_share", "eda_distance_discount")))
_CHART_VALUES = {
    "profile": ["rows", "receipts", "purchases", "users", "merchants", "coupons"], "missing": ["nulls", "share"],
    "daily": ["received", "max_received"], "distance_counts": ["rows"], "distance_rate": ["rate", "rows", "redeemed"],
    "discount_counts": ["received", "redeemed"], "monthly": ["redeemed", "received", "consumed"],
    "weekday": ["received", "redeemed"], "type_share": ["rows", "share"], "type_share_redeemed": ["rows", "share"],
    "label_share": ["rows", "share"], "distance_discount": ["rows"]}


def _eda_all_sql() -> str:
    """The twelve single oracles as one long table."""
    parts = []
    for chart, keys in _CHART_COLUMNS.items():
        key = [f"CAST({'round(ratio * 1000000)' if k == 'ratio' else k} AS VARCHAR)" for k in keys]
        key = [k.replace("AS VARCHAR", "AS BIGINT) AS VARCHAR").replace("CAST(round", "CAST(CAST(round") if "ratio" in k else k for k in key]
        key += ["CAST(NULL AS VARCHAR)"] * (2 - len(key))
        for v in _CHART_VALUES[chart]:
            parts.append(f"SELECT '{chart}' AS chart, {key[0]} AS key1, {key[1]} AS key2, '{v}' AS metric, "
                         f"round(CAST({v} AS DOUBLE), 6) AS value FROM ({ORACLE[_CHART_ORACLE[chart]]})")
    return "\nUNION ALL ".join(parts)


@register("eda_all", _eda_all_sql())
def q_eda_all(spark, d):
    """The twelve chart tables from one aggregate with grouping sets: the log is read once."""
    lg = log(spark, d)
    path = scratch_path(spark, "chart-counts")
    eda.all_counts(lg).write.parquet(path)
    out = None
    for chart, df in eda.charts(spark.read.parquet(path), lg.columns).items():
        keys = [(F.round(F.col(k) * 1000000).cast("long") if k == "ratio" else F.col(k)).cast("string") for k in _CHART_COLUMNS[chart]]
        keys += [F.lit(None).cast("string")] * (2 - len(keys))
        values = F.array(*[F.struct(F.lit(v).alias("metric"), F.round(F.col(v).cast("double"), 6).alias("value"))
                           for v in _CHART_VALUES[chart]])
        one = df.select(F.lit(chart).alias("chart"), keys[0].alias("key1"), keys[1].alias("key2"), F.explode(values).alias("_v"))
        one = one.select("chart", "key1", "key2", "_v.metric", "_v.value")
        out = one if out is None else out.unionByName(one)
    return out


# ====================================================================== Family B
_SIMPLE_SQL = """stats AS (
  SELECT user_id, coupon_id, date_received, COUNT(*) AS n_ucd,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, coupon_id) AS n_uc,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, date_received) AS n_ud,
    SUM(COUNT(*)) OVER (PARTITION BY user_id) AS n_u
  FROM tl GROUP BY user_id, coupon_id, date_received)"""


@register("feat_simple", S.with_(PB, TL_CTE, _SIMPLE_SQL) + """SELECT tl.user_id, tl.merchant_id,
  tl.coupon_id, tl.discount_text, tl.distance, tl.date_received, tl.date, tl.is_manjian,
  round(tl.discount_rate, 6) AS discount_rate, tl.min_cost_of_manjian, tl.null_distance, tl.label,
  CAST(n_u AS BIGINT) AS simple_User_id_receive_cnt,
  CAST(n_uc AS BIGINT) AS simple_User_id_Coupon_id_receive_cnt,
  CAST(n_ud AS BIGINT) AS simple_User_id_Date_received_receive_cnt,
  n_ucd AS simple_User_id_Coupon_id_Date_received_receive_cnt,
  CAST(n_ucd > 1 AS INTEGER) AS simple_User_id_Coupon_id_Date_received_repeat_receive
  FROM tl JOIN stats USING (user_id, coupon_id, date_received)""")
def q_feat_simple(spark, d):
    return r6(B.simple_features(tl(spark, d)))


_WEEK_SQL = ", ".join(f"CAST({S.wd0('date_received')} = {i} AS INTEGER) AS week_{i}" for i in range(7))


@register("feat_week", S.with_(PB, TL_CTE) + f"""SELECT user_id, coupon_id, date_received,
  {S.wd0('date_received')} AS week,
  CAST({S.wd0('date_received')} IN (5, 6) AS INTEGER) AS is_weekend, {_WEEK_SQL} FROM tl""")
def q_feat_week(spark, d):
    return B.week_features(tl(spark, d).select("user_id", "coupon_id", "date_received"))


def _hist_sql(keys: list[str], aggs: str, select: str) -> str:
    k = ", ".join(keys)
    kn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    return S.with_(PB, TL_CTE, TH_CTE,
                   f"spine AS (SELECT DISTINCT {k} FROM tl WHERE {kn})",
                   f"h AS (SELECT {k}, {aggs} FROM th GROUP BY {k})") + \
        f"SELECT {k}, {select} FROM spine LEFT JOIN h USING ({k})"


_HU = "history_field_User_id_"
_HM = "history_field_Merchant_id_"
_HC = "history_field_Coupon_id_"
_HUC = "history_field_User_id_Coupon_id_"


@register("feat_hist_user", _hist_sql(
    ["user_id"],
    "COUNT(*) AS rc, COUNT(*) FILTER (WHERE date IS NULL) AS nc, "
    "COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, COUNT(DISTINCT merchant_id) AS dm, "
    "COUNT(DISTINCT merchant_id) FILTER (WHERE label = 1) AS dm15",
    f"COALESCE(rc, 0) AS {_HU}receive_cnt, COALESCE(nc, 0) AS {_HU}receive_not_consume_cnt, "
    f"COALESCE(cc, 0) AS {_HU}receive_and_consume_cnt, "
    f"round({S.rate_zero('COALESCE(cc, 0)', 'COALESCE(rc, 0)')}, 6) AS {_HU}receive_and_consume_rate, "
    f"COALESCE(dm, 0) AS {_HU}receive_differ_Merchant_cnt, "
    f"COALESCE(dm15, 0) AS {_HU}receive_and_consume_differ_Merchant_cnt_15"))
def q_feat_hist_user(spark, d):
    return r6(B.hist_user(tl(spark, d), th(spark, d)))


@register("feat_hist_merchant", _hist_sql(
    ["merchant_id"],
    "COUNT(*) AS rc, COUNT(DISTINCT user_id) AS du, COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, "
    "COUNT(*) FILTER (WHERE date IS NULL) AS nc, COUNT(DISTINCT coupon_id) AS dc",
    f"COALESCE(rc, 0) AS {_HM}received_cnt, COALESCE(du, 0) AS {_HM}received_differ_User_cnt, "
    f"COALESCE(cc, 0) AS {_HM}received_and_consumed_cnt, "
    f"round({S.rate_zero('COALESCE(cc, 0)', 'COALESCE(rc, 0)')}, 6) AS {_HM}received_and_consumed_rate, "
    f"COALESCE(nc, 0) AS {_HM}received_not_consumed_cnt, COALESCE(dc, 0) AS {_HM}differ_Coupon_cnt"))
def q_feat_hist_merchant(spark, d):
    return r6(B.hist_merchant(tl(spark, d), th(spark, d)))


@register("feat_hist_coupon", _hist_sql(
    ["coupon_id"],
    "COUNT(*) AS rc, COUNT(*) FILTER (WHERE label = 1) AS c15, "
    "AVG(date_diff('day', date_received, date)) FILTER (WHERE label = 1) AS gap, "
    "MEDIAN(min_cost_of_manjian) FILTER (WHERE is_manjian = 1) AS med",
    f"COALESCE(rc, 0) AS {_HC}received_cnt, COALESCE(c15, 0) AS {_HC}received_and_consumed_cnt_15, "
    f"round({S.rate_zero('COALESCE(c15, 0)', 'COALESCE(rc, 0)')}, 6) AS {_HC}received_and_consumed_rate_15, "
    f"round(COALESCE(gap, -1.0), 6) AS {_HC}consumed_mean_time_gap_15, "
    f"round(COALESCE(CAST(med AS DOUBLE), 0.0), 6) AS {_HC}median_of_min_cost_of_manjian"))
def q_feat_hist_coupon(spark, d):
    return r6(B.hist_coupon(tl(spark, d), th(spark, d)))


@register("feat_hist_user_coupon", _hist_sql(
    ["user_id", "coupon_id"],
    "COUNT(*) AS rc, COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc",
    f"COALESCE(rc, 0) AS {_HUC}receive_cnt, COALESCE(cc, 0) AS {_HUC}receive_and_consume_cnt, "
    f"round({S.rate_zero('COALESCE(cc, 0)', 'COALESCE(rc, 0)')}, 6) AS {_HUC}receive_and_consume_rate"))
def q_feat_hist_user_coupon(spark, d):
    return r6(B.hist_user_coupon(tl(spark, d), th(spark, d)))


@register("feat_hist_user_ext", _hist_sql(
    ["user_id"],
    "COUNT(*) AS rc, COUNT(*) FILTER (WHERE date IS NULL) AS nc, "
    "COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, "
    "AVG(discount_rate) FILTER (WHERE date IS NOT NULL) AS md, "
    "AVG(distance) FILTER (WHERE date IS NOT NULL AND distance <> -1) AS mdist, "
    "COUNT(DISTINCT merchant_id) FILTER (WHERE date IS NOT NULL) AS dmc, "
    "COUNT(DISTINCT merchant_id) AS dm",
    f"COALESCE(rc, 0) AS {_HU}receive_cnt, COALESCE(nc, 0) AS {_HU}receive_not_consume_cnt, "
    f"COALESCE(cc, 0) AS {_HU}receive_and_consume_cnt, "
    f"round({S.rate_zero('COALESCE(cc, 0)', 'COALESCE(rc, 0)')}, 6) AS {_HU}receive_and_consume_rate, "
    f"round(COALESCE(md, 0.0), 6) AS {_HU}receive_and_consume_mean_discount_rate, "
    f"round(COALESCE(mdist, 0.0), 6) AS {_HU}receive_and_consume_mean_distance, "
    f"COALESCE(dmc, 0) AS {_HU}receive_differ_Merchant_and_consume_cnt, "
    f"COALESCE(dm, 0) AS {_HU}receive_differ_Merchant_cnt, "
    f"round({S.rate_zero('COALESCE(dmc, 0)', 'COALESCE(dm, 0)')}, 6) AS "
    f"{_HU}receive_differ_Merchant_consume_rate"))
def q_feat_hist_user_ext(spark, d):
    return r6(B.hist_user_ext(tl(spark, d), th(spark, d)))


def _assemble_sql(label_w: str, hist_w: str, name: str, labelled: bool = True) -> tuple[str, str]:
    """CTE list + final SELECT of one Family B assembled set."""
    src = "pb" if labelled else "pt"
    ctes = [
        f"{name}_l AS (SELECT * FROM {src} WHERE {label_w})",
        f"{name}_h AS (SELECT * FROM pb WHERE {hist_w})",
        f"""{name}_s AS (SELECT user_id, coupon_id, date_received, COUNT(*) AS n_ucd,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, coupon_id) AS n_uc,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, date_received) AS n_ud,
    SUM(COUNT(*)) OVER (PARTITION BY user_id) AS n_u
  FROM {name}_l GROUP BY user_id, coupon_id, date_received)""",
        f"""{name}_hu AS (SELECT user_id, COUNT(*) AS rc, COUNT(*) FILTER (WHERE date IS NULL) AS nc,
    COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, COUNT(DISTINCT merchant_id) AS dm,
    COUNT(DISTINCT merchant_id) FILTER (WHERE label = 1) AS dm15 FROM {name}_h GROUP BY user_id)""",
        f"""{name}_hm AS (SELECT merchant_id, COUNT(*) AS rc, COUNT(DISTINCT user_id) AS du,
    COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, COUNT(*) FILTER (WHERE date IS NULL) AS nc,
    COUNT(DISTINCT coupon_id) AS dc FROM {name}_h GROUP BY merchant_id)""",
        f"""{name}_hc AS (SELECT coupon_id, COUNT(*) AS rc, COUNT(*) FILTER (WHERE label = 1) AS c15,
    AVG(date_diff('day', date_received, date)) FILTER (WHERE label = 1) AS gap,
    MEDIAN(min_cost_of_manjian) FILTER (WHERE is_manjian = 1) AS med
    FROM {name}_h GROUP BY coupon_id)""",
        f"""{name}_huc AS (SELECT user_id, coupon_id, COUNT(*) AS rc,
    COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc FROM {name}_h GROUP BY user_id, coupon_id)""",
    ]
    label_col = ", l.label" if labelled else ""
    sel = f"""SELECT DISTINCT l.user_id, l.coupon_id, l.distance, l.date_received, l.is_manjian,
  round(l.discount_rate, 6) AS discount_rate, l.min_cost_of_manjian, l.null_distance,
  {S.wd0('l.date_received')} AS week,
  CAST({S.wd0('l.date_received')} IN (5, 6) AS INTEGER) AS is_weekend,
  {", ".join(f"CAST({S.wd0('l.date_received')} = {i} AS INTEGER) AS week_{i}" for i in range(7))},
  CAST(s.n_u AS BIGINT) AS simple_User_id_receive_cnt,
  CAST(s.n_uc AS BIGINT) AS simple_User_id_Coupon_id_receive_cnt,
  CAST(s.n_ud AS BIGINT) AS simple_User_id_Date_received_receive_cnt,
  s.n_ucd AS simple_User_id_Coupon_id_Date_received_receive_cnt,
  CAST(s.n_ucd > 1 AS INTEGER) AS simple_User_id_Coupon_id_Date_received_repeat_receive,
  COALESCE(hu.rc, 0) AS {_HU}receive_cnt, COALESCE(hu.nc, 0) AS {_HU}receive_not_consume_cnt,
  COALESCE(hu.cc, 0) AS {_HU}receive_and_consume_cnt,
  round({S.rate_zero('COALESCE(hu.cc, 0)', 'COALESCE(hu.rc, 0)')}, 6) AS {_HU}receive_and_consume_rate,
  COALESCE(hu.dm, 0) AS {_HU}receive_differ_Merchant_cnt,
  COALESCE(hu.dm15, 0) AS {_HU}receive_and_consume_differ_Merchant_cnt_15,
  COALESCE(hm.rc, 0) AS {_HM}received_cnt, COALESCE(hm.du, 0) AS {_HM}received_differ_User_cnt,
  COALESCE(hm.cc, 0) AS {_HM}received_and_consumed_cnt,
  round({S.rate_zero('COALESCE(hm.cc, 0)', 'COALESCE(hm.rc, 0)')}, 6) AS {_HM}received_and_consumed_rate,
  COALESCE(hm.nc, 0) AS {_HM}received_not_consumed_cnt, COALESCE(hm.dc, 0) AS {_HM}differ_Coupon_cnt,
  COALESCE(hc.rc, 0) AS {_HC}received_cnt, COALESCE(hc.c15, 0) AS {_HC}received_and_consumed_cnt_15,
  round({S.rate_zero('COALESCE(hc.c15, 0)', 'COALESCE(hc.rc, 0)')}, 6) AS {_HC}received_and_consumed_rate_15,
  round(COALESCE(hc.gap, -1.0), 6) AS {_HC}consumed_mean_time_gap_15,
  round(COALESCE(CAST(hc.med AS DOUBLE), 0.0), 6) AS {_HC}median_of_min_cost_of_manjian,
  COALESCE(huc.rc, 0) AS {_HUC}receive_cnt, COALESCE(huc.cc, 0) AS {_HUC}receive_and_consume_cnt,
  round({S.rate_zero('COALESCE(huc.cc, 0)', 'COALESCE(huc.rc, 0)')}, 6) AS {_HUC}receive_and_consume_rate
  {label_col}
FROM {name}_l l
  LEFT JOIN {name}_s s USING (user_id, coupon_id, date_received)
  LEFT JOIN {name}_hu hu ON hu.user_id = l.user_id
  LEFT JOIN {name}_hm hm ON hm.merchant_id = l.merchant_id
  LEFT JOIN {name}_hc hc ON hc.coupon_id = l.coupon_id
  LEFT JOIN {name}_huc huc ON huc.user_id = l.user_id AND huc.coupon_id = l.coupon_id"""
    return ",\n".join(ctes), sel


_TRAIN_CTES, _TRAIN_SEL = _assemble_sql(TL_W, TH_W, "tr")
_VAL_CTES, _VAL_SEL = _assemble_sql(S.half_open("date_received", "2016-03-31", "2016-05-01"),
                                    S.half_open("date_received", "2016-01-16", "2016-03-16"), "va")


_TEST_CTES, _TEST_SEL = _assemble_sql(S.TEST_WHERE, S.half_open("date_received", "2016-04-17",
                                                                "2016-06-16"), "te", labelled=False)
PT = ("pt AS (" + S.prep_b(f"(SELECT user_id, merchant_id, coupon_id, discount_rate, distance, "
                           f"date_received FROM coupon WHERE {S.TEST_WHERE})", with_date=False) + ")")


@register("ds_test", S.with_(PB, PT, _TEST_CTES) + _TEST_SEL)
def q_ds_test(spark, d):
    """B-8 on the July test table (no ``date``, no label): the set the
    Family B model scores."""
    lg = log(spark, d)
    return r6(assemble.b_dataset(lg, "test", offline_test(lg), grain=b_grain(spark, d)))


@register("ds_assemble", S.with_(PB, _TRAIN_CTES) + _TRAIN_SEL)
def q_ds_assemble(spark, d):
    return r6(assemble.b_dataset(log(spark, d), "train", grain=b_grain(spark, d)))


@register("ds_big_train", S.with_(PB, _TRAIN_CTES, _VAL_CTES)
          + "SELECT * FROM (" + _TRAIN_SEL + ") UNION ALL SELECT * FROM (" + _VAL_SEL + ")")
def q_ds_big_train(spark, d):
    return r6(assemble.b_big_train(log(spark, d), grain=b_grain(spark, d)))


# ====================================================================== Family A
_A_MERCHANT_SQL = """SELECT merchant_id,
    NULLIF(COUNT(*) FILTER (WHERE date IS NOT NULL), 0) AS total_sales,
    COUNT(*) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS sales_use_coupon,
    COUNT(*) FILTER (WHERE coupon_id IS NOT NULL) AS total_coupon,
    MIN(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS merchant_min_distance,
    MAX(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS merchant_max_distance,
    AVG(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS merchant_mean_distance,
    MEDIAN(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS merchant_median_distance
  FROM {src} GROUP BY merchant_id"""
_A_MERCHANT_OUT = """merchant_id, total_sales, sales_use_coupon, total_coupon, merchant_min_distance,
  merchant_max_distance, round(merchant_mean_distance, 6) AS merchant_mean_distance,
  round(CAST(merchant_median_distance AS DOUBLE), 6) AS merchant_median_distance,
  round(CAST(sales_use_coupon AS DOUBLE) / NULLIF(total_coupon, 0), 6) AS merchant_coupon_transfer_rate,
  round(CAST(sales_use_coupon AS DOUBLE) / total_sales, 6) AS coupon_rate"""

_A_USER_SQL = """SELECT user_id,
    COUNT(DISTINCT merchant_id) FILTER (WHERE date IS NOT NULL) AS count_merchant,
    MIN(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS user_min_distance,
    MAX(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS user_max_distance,
    AVG(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS user_mean_distance,
    MEDIAN(distance) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS user_median_distance,
    COUNT(*) FILTER (WHERE date IS NOT NULL AND coupon_id IS NOT NULL) AS buy_use_coupon,
    COUNT(*) FILTER (WHERE date IS NOT NULL) AS buy_total,
    COUNT(*) FILTER (WHERE coupon_id IS NOT NULL) AS coupon_received,
    AVG(date_diff('day', date_received, date)) AS avg_user_date_datereceived_gap,
    CAST(MIN(date_diff('day', date_received, date)) AS INTEGER) AS min_user_date_datereceived_gap,
    CAST(MAX(date_diff('day', date_received, date)) AS INTEGER) AS max_user_date_datereceived_gap
  FROM {src} GROUP BY user_id"""
_A_USER_OUT = """user_id, count_merchant, user_min_distance, user_max_distance,
  round(user_mean_distance, 6) AS user_mean_distance,
  round(CAST(user_median_distance AS DOUBLE), 6) AS user_median_distance,
  buy_use_coupon, buy_total, coupon_received,
  round(avg_user_date_datereceived_gap, 6) AS avg_user_date_datereceived_gap,
  min_user_date_datereceived_gap, max_user_date_datereceived_gap,
  round(CAST(buy_use_coupon AS DOUBLE) / NULLIF(buy_total, 0), 6) AS buy_use_coupon_rate,
  round(CAST(buy_use_coupon AS DOUBLE) / NULLIF(coupon_received, 0), 6) AS user_coupon_transfer_rate"""

_A_UM_SQL = """SELECT user_id, merchant_id,
    NULLIF(COUNT(*) FILTER (WHERE date IS NOT NULL), 0) AS user_merchant_buy_total,
    NULLIF(COUNT(*) FILTER (WHERE coupon_id IS NOT NULL), 0) AS user_merchant_received,
    COUNT(*) FILTER (WHERE date IS NOT NULL AND date_received IS NOT NULL) AS user_merchant_buy_use_coupon,
    COUNT(*) AS user_merchant_any,
    COUNT(*) FILTER (WHERE date IS NOT NULL AND coupon_id IS NULL) AS user_merchant_buy_common
  FROM {src} GROUP BY user_id, merchant_id"""
_A_UM_OUT = """user_id, merchant_id, user_merchant_buy_total, user_merchant_received,
  user_merchant_buy_use_coupon, user_merchant_any, user_merchant_buy_common,
  round(CAST(user_merchant_buy_use_coupon AS DOUBLE) / user_merchant_received, 6)
    AS user_merchant_coupon_transfer_rate,
  round(CAST(user_merchant_buy_use_coupon AS DOUBLE) / user_merchant_buy_total, 6)
    AS user_merchant_coupon_buy_rate,
  round(CAST(user_merchant_buy_total AS DOUBLE) / user_merchant_any, 6) AS user_merchant_rate,
  round(CAST(user_merchant_buy_common AS DOUBLE) / user_merchant_buy_total, 6)
    AS user_merchant_common_buy_rate"""

A2F_CTE = f"f2 AS (SELECT * FROM coupon WHERE {A2F_W})"
A2D_CTE = f"d2 AS (SELECT * FROM coupon WHERE {A2D_W})"


@register("a_merchant", S.with_(A2F_CTE, f"m AS ({_A_MERCHANT_SQL.format(src='f2')})")
          + f"SELECT {_A_MERCHANT_OUT} FROM m")
def q_a_merchant(spark, d):
    _, f = a2(spark, d)
    return r6(A.merchant_features(f))


@register("a_user", S.with_(A2F_CTE, f"u AS ({_A_USER_SQL.format(src='f2')})")
          + f"SELECT {_A_USER_OUT} FROM u")
def q_a_user(spark, d):
    _, f = a2(spark, d)
    return r6(A.user_features(f))


@register("feat_user_gap", S.with_(A2F_CTE) + """SELECT user_id,
  round(AVG(date_diff('day', date_received, date)), 6) AS avg_user_date_datereceived_gap,
  CAST(MIN(date_diff('day', date_received, date)) AS INTEGER) AS min_user_date_datereceived_gap,
  CAST(MAX(date_diff('day', date_received, date)) AS INTEGER) AS max_user_date_datereceived_gap
  FROM f2 WHERE date IS NOT NULL AND date_received IS NOT NULL GROUP BY user_id""")
def q_feat_user_gap(spark, d):
    _, f = a2(spark, d)
    both = f.where(F.col("date").isNotNull() & F.col("date_received").isNotNull())
    return r6(A.user_gap_features(both))


@register("a_user_merchant", S.with_(A2F_CTE, f"um AS ({_A_UM_SQL.format(src='f2')})")
          + f"SELECT {_A_UM_OUT} FROM um")
def q_a_user_merchant(spark, d):
    _, f = a2(spark, d)
    return r6(A.user_merchant_features(f))


_A_COUPON_OUT = f"""user_id, merchant_id, coupon_id, round({S.ratio_a()}, 6) AS discount_rate, distance,
  date_received, {{date}}{S.isodow('date_received')} AS day_of_week,
  CAST(dayofmonth(date_received) AS INTEGER) AS day_of_month,
  {S.days('date_received', "DATE '{anchor}'")} AS days_distance,
  {S.man()} AS discount_man, {S.jian()} AS discount_jian, {S.is_manjian()} AS is_man_jian,
  COUNT(coupon_id) OVER (PARTITION BY coupon_id) AS coupon_count"""


@register("a_coupon", S.with_(A2D_CTE) + "SELECT "
          + _A_COUPON_OUT.replace("{date}", "date, ").replace("{anchor}", "2016-05-14") + " FROM d2")
def q_a_coupon(spark, d):
    data, _ = a2(spark, d)
    return r6(A.coupon_features(data, split.A_SETS[2].anchor))


_OTHER_CTE = """o AS (SELECT user_id, coupon_id, date_received, COUNT(*) AS n_ucd,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, coupon_id) AS n_uc,
    SUM(COUNT(*)) OVER (PARTITION BY user_id, date_received) AS n_ud,
    SUM(COUNT(*)) OVER (PARTITION BY user_id) AS n_u,
    MIN(date_received) OVER (PARTITION BY user_id, coupon_id) AS first_day,
    MAX(date_received) OVER (PARTITION BY user_id, coupon_id) AS last_day,
    LAG(date_received) OVER (PARTITION BY user_id, coupon_id ORDER BY date_received) AS prev_day,
    LEAD(date_received) OVER (PARTITION BY user_id, coupon_id ORDER BY date_received) AS next_day
  FROM {src} WHERE coupon_id IS NOT NULL AND date_received IS NOT NULL
  GROUP BY user_id, coupon_id, date_received)"""
_LAST = ("CASE WHEN n_uc <= 1 THEN -1 WHEN date_received = last_day THEN 1 ELSE 0 END "
         "AS this_month_user_receive_same_coupon_lastone")
_FIRST = ("CASE WHEN n_uc <= 1 THEN -1 WHEN date_received = first_day THEN 1 ELSE 0 END "
          "AS this_month_user_receive_same_coupon_firstone")
_GAPB = f"COALESCE({S.days('date_received', 'prev_day')}, -1) AS day_gap_before"
_GAPA = f"COALESCE({S.days('next_day', 'date_received')}, -1) AS day_gap_after"
_OTHER_OUT = f"""user_id, coupon_id, date_received,
  CAST(n_uc AS BIGINT) AS this_month_user_receive_same_coupon_count,
  CAST(n_u AS BIGINT) AS this_month_user_receive_all_coupon_count, {_LAST}, {_FIRST},
  CAST(n_ud AS BIGINT) AS this_day_user_receive_all_coupon_count,
  n_ucd AS this_day_user_receive_same_coupon_count, {_GAPB}, {_GAPA}"""


# W1, W2 told from the raw rows: every receipt against the other receipts of its
# user and coupon
_PEERS = """r AS (SELECT * FROM d2 WHERE coupon_id IS NOT NULL AND date_received IS NOT NULL),
peers AS (SELECT a.user_id, a.coupon_id, a.date_received, COUNT(*) AS n_pair,
    COUNT(*) FILTER (WHERE b.date_received > a.date_received) AS later,
    COUNT(*) FILTER (WHERE b.date_received < a.date_received) AS earlier,
    MIN(date_diff('day', b.date_received, a.date_received)) FILTER (WHERE b.date_received < a.date_received) AS back,
    MIN(date_diff('day', a.date_received, b.date_received)) FILTER (WHERE b.date_received > a.date_received) AS ahead
  FROM (SELECT DISTINCT user_id, coupon_id, date_received FROM r) a
    JOIN r b ON b.user_id = a.user_id AND b.coupon_id = a.coupon_id GROUP BY ALL)"""


@register("a_first_last", S.with_(A2D_CTE, _PEERS) + """SELECT user_id, coupon_id, date_received,
  CASE WHEN n_pair = 1 THEN -1 WHEN later = 0 THEN 1 ELSE 0 END AS this_month_user_receive_same_coupon_lastone,
  CASE WHEN n_pair = 1 THEN -1 WHEN earlier = 0 THEN 1 ELSE 0 END AS this_month_user_receive_same_coupon_firstone
  FROM r JOIN peers USING (user_id, coupon_id, date_received)""")
def q_a_first_last(spark, d):
    data, _ = a2(spark, d)
    flags = first_last_flags(pair_day_stats(data)).select(
        "user_id", "coupon_id", "date_received", "this_month_user_receive_same_coupon_lastone",
        "this_month_user_receive_same_coupon_firstone")
    return data.select("user_id", "coupon_id", "date_received").join(
        flags, ["user_id", "coupon_id", "date_received"])


@register("a_day_gap", S.with_(A2D_CTE, _PEERS) + """SELECT user_id, coupon_id, date_received,
  CAST(COALESCE(back, -1) AS INTEGER) AS day_gap_before, CAST(COALESCE(ahead, -1) AS INTEGER) AS day_gap_after
  FROM r JOIN peers USING (user_id, coupon_id, date_received)""")
def q_a_day_gap(spark, d):
    data, _ = a2(spark, d)
    gaps = day_gaps(pair_day_stats(data)).select(
        "user_id", "coupon_id", "date_received", "day_gap_before", "day_gap_after")
    return data.select("user_id", "coupon_id", "date_received").join(
        gaps, ["user_id", "coupon_id", "date_received"])


@register("a_other", S.with_(A2D_CTE, _OTHER_CTE.format(src="d2")) + f"SELECT {_OTHER_OUT} FROM o")
def q_a_other(spark, d):
    data, _ = a2(spark, d)
    return A.other_features(data)


@register("agg_date_list", S.with_(A2D_CTE) + """SELECT user_id, coupon_id,
  string_agg(strftime(date_received, '%Y%m%d') || ':' || n, ',' ORDER BY date_received) AS dates,
  string_agg(strftime(date_received, '%Y%m%d'), ':' ORDER BY date_received) AS days_text
  FROM (SELECT user_id, coupon_id, date_received, COUNT(*) AS n FROM d2
        WHERE coupon_id IS NOT NULL AND date_received IS NOT NULL GROUP BY ALL)
  GROUP BY user_id, coupon_id""")
def q_agg_date_list(spark, d):
    data, _ = a2(spark, d)
    return date_list_text(date_lists(data))


def _a_dataset_sql(data_where: str, feat_where: str, anchor: str, labelled: bool) -> str:
    date_col = "date, " if labelled else ""
    src_cols = "user_id, merchant_id, coupon_id, discount_rate, distance, date_received" + (
        ", date" if labelled else "")
    ctes = [
        f"dfull AS (SELECT {src_cols} FROM coupon WHERE {data_where})",
        f"ff AS (SELECT * FROM coupon WHERE {feat_where})",
        f"cf AS (SELECT " + _A_COUPON_OUT.replace("{date}", date_col).replace("{anchor}", anchor)
        + " FROM dfull)",
        f"m AS ({_A_MERCHANT_SQL.format(src='ff')})",
        f"mo AS (SELECT {_A_MERCHANT_OUT} FROM m)",
        f"u AS ({_A_USER_SQL.format(src='ff')})",
        f"uo AS (SELECT {_A_USER_OUT} FROM u)",
        f"um AS ({_A_UM_SQL.format(src='ff')})",
        f"umo AS (SELECT {_A_UM_OUT} FROM um)",
        _OTHER_CTE.format(src="dfull"),
        f"oo AS (SELECT {_OTHER_OUT} FROM o)",
    ]
    keep = ["user_id"] + ([] if labelled else ["coupon_id"]) + ["discount_rate", "distance"] + (
        [] if labelled else ["date_received"]) + ["day_of_month", "days_distance", "discount_man",
                                                  "discount_jian", "is_man_jian"]
    m_cols = ["total_sales", "sales_use_coupon", "total_coupon", "merchant_min_distance",
              "merchant_max_distance", "merchant_mean_distance", "merchant_median_distance",
              "merchant_coupon_transfer_rate", "coupon_rate"]
    u_cols = ["count_merchant", "user_min_distance", "user_max_distance", "user_mean_distance",
              "user_median_distance", "buy_use_coupon", "buy_total", "coupon_received",
              "avg_user_date_datereceived_gap", "min_user_date_datereceived_gap",
              "max_user_date_datereceived_gap", "buy_use_coupon_rate", "user_coupon_transfer_rate"]
    # joined rows are deduplicated with their keys, then the keys go
    keys = ["merchant_id", "coupon_id", "date_received", "day_of_week", "coupon_count"] + (
        ["date"] if labelled else [])
    sel = [f"cf.{c} AS k_{c}" for c in keys]
    sel += [f"cf.{c}" for c in keep] + [f"mo.{c}" for c in m_cols] + [f"uo.{c}" for c in u_cols]
    sel += ["COALESCE(umo.user_merchant_buy_total, 0) AS user_merchant_buy_total",
            "COALESCE(umo.user_merchant_received, 0) AS user_merchant_received",
            "umo.user_merchant_buy_use_coupon",
            "COALESCE(umo.user_merchant_any, 0) AS user_merchant_any",
            "umo.user_merchant_buy_common", "umo.user_merchant_coupon_transfer_rate",
            "umo.user_merchant_coupon_buy_rate", "umo.user_merchant_rate",
            "umo.user_merchant_common_buy_rate"]
    sel += [f"oo.{c}" for c in A.OTHER_COLUMNS]
    sel += [f"CAST({S.isodow('cf.date_received')} IN (6, 7) AS INTEGER) AS is_weekend"]
    sel += [f"CAST({S.isodow('cf.date_received')} = {i} AS INTEGER) AS weekday{i}" for i in range(1, 8)]
    if labelled:
        sel += [f"{S.label_a('cf.date', 'cf.date_received')} AS label"]
    return S.with_(*ctes) + "SELECT * EXCLUDE (" + ", ".join(f"k_{c}" for c in keys) + ") FROM (SELECT DISTINCT " + \
        ",\n  ".join(sel) + """
FROM cf LEFT JOIN mo ON mo.merchant_id = cf.merchant_id
  LEFT JOIN uo ON uo.user_id = cf.user_id
  LEFT JOIN umo ON umo.user_id = cf.user_id AND umo.merchant_id = cf.merchant_id
  LEFT JOIN oo ON oo.user_id = cf.user_id AND oo.coupon_id = cf.coupon_id
    AND oo.date_received = cf.date_received)"""


@register("a_dataset_train", _a_dataset_sql(A2D_W, A2F_W, "2016-05-14", True))
def q_a_dataset_train(spark, d):
    return r6(assemble.a_dataset(log(spark, d), 2, grain=a_grain(spark, d)))


@register("a_dataset_set1", _a_dataset_sql(
    S.between("date_received", "2016-04-14", "2016-05-14"),
    S.between("COALESCE(date, date_received)", "2016-01-01", "2016-04-13"), "2016-04-13", True))
def q_a_dataset_set1(spark, d):
    """A-6 for set 1 (dataset 04-14..05-14, features 01-01..04-13)."""
    return r6(assemble.a_dataset(log(spark, d), 1, grain=a_grain(spark, d)))


@register("a_dataset_test", _a_dataset_sql(S.TEST_WHERE, A3F_W, "2016-06-30", False))
def q_a_dataset_test(spark, d):
    lg = log(spark, d)
    return r6(assemble.a_dataset(lg, 3, offline_test(lg), a_grain(spark, d)))


# ====================================================================== all splits at once
def _a_all_sql(body: str, out: str) -> str:
    """One Family A block of the three sets, each from its own feature window."""
    windows = {"set1": ("2016-01-01", "2016-04-13"), "set2": ("2016-02-01", "2016-05-14"), "set3": ("2016-03-15", "2016-06-30")}
    ctes, parts = [], []
    for name, (first, last) in windows.items():
        ctes.append(f"f_{name} AS (SELECT * FROM coupon WHERE {S.between('COALESCE(date, date_received)', first, last)})")
        ctes.append(f"b_{name} AS ({body.format(src='f_' + name)})")
        parts.append(f"SELECT '{name}' AS part, {out} FROM b_{name}")
    return S.with_(*ctes) + "\nUNION ALL ".join(parts)


@register("a_merchant_sets", _a_all_sql(_A_MERCHANT_SQL, _A_MERCHANT_OUT))
def q_a_merchant_sets(spark, d):
    """A-3 of all three sets from the day-grain partials."""
    return r6(daygrain.a_merchant(a_grain(spark, d)))


@register("a_user_sets", _a_all_sql(_A_USER_SQL, _A_USER_OUT))
def q_a_user_sets(spark, d):
    return r6(daygrain.a_user(a_grain(spark, d)))


@register("a_user_merchant_sets", _a_all_sql(_A_UM_SQL, _A_UM_OUT))
def q_a_user_merchant_sets(spark, d):
    return r6(daygrain.a_user_merchant(a_grain(spark, d), tasks=True))


_B_HISTORY = {"train": ("2016-03-02", "2016-04-30"), "validate": ("2016-01-16", "2016-03-15"),
              "test": ("2016-04-17", "2016-06-15")}
_B_LABEL = {"train": ("2016-05-16", "2016-06-15"), "validate": ("2016-03-31", "2016-04-30"),
            "test": ("2016-07-01", "2016-07-31")}


def _b_all_sql(query: str) -> str:
    """One Family B block of the three splits: its single-split oracle with other days."""
    _, body = ORACLE[query].split(TL_CTE + ",\n" + TH_CTE, 1)
    spine, select = body.split("\nSELECT ", 1) if "\nSELECT " in body else body.split(")SELECT ", 1)
    ctes, parts = [], []
    for name in _B_HISTORY:
        ctes.append(f"tl_{name} AS (SELECT * FROM pb WHERE {S.between('date_received', *_B_LABEL[name])})")
        ctes.append(f"th_{name} AS (SELECT * FROM pb WHERE {S.between('date_received', *_B_HISTORY[name])})")
        own = spine.lstrip(",\n").replace("spine AS", f"spine_{name} AS").replace("\nh AS", f"\nh_{name} AS")
        ctes.append(own.replace("FROM tl ", f"FROM tl_{name} ").replace("FROM th ", f"FROM th_{name} "))
        parts.append(f"SELECT '{name}' AS part, " + select.replace("FROM spine LEFT JOIN h", f"FROM spine_{name} LEFT JOIN h_{name}"))
    return S.with_(PB, *ctes) + "\nUNION ALL ".join(parts)


def _hist_splits(name: str):
    @register(f"feat_hist_{name}_splits", _b_all_sql(f"feat_hist_{name}"))
    def query(spark, d):
        lg = log(spark, d)
        labels = assemble.b_labels(lg, ["train", "validate", "test"], offline_test(lg))
        return r6(daygrain.hist(name, labels, b_grain(spark, d), tasks=True))
    query.__doc__ = f"The history block ``{name}`` of all three splits from the day-grain partials."


for _name in ("user", "merchant", "coupon", "user_coupon", "user_ext"):
    _hist_splits(_name)


@register("ds_handover", S.with_(PB, TL_CTE, TH_CTE, "h AS (SELECT user_id, COUNT(*) AS rc, "
  "COUNT(*) FILTER (WHERE date IS NOT NULL) AS cc, COUNT(DISTINCT merchant_id) AS dm FROM th GROUP BY user_id)") + f"""SELECT user_id, coupon_id, date_received, label, COALESCE(rc, 0) AS {_HU}receive_cnt,
  COALESCE(cc, 0) AS {_HU}receive_and_consume_cnt, COALESCE(dm, 0) AS {_HU}receive_differ_Merchant_cnt
  FROM tl LEFT JOIN h USING (user_id)""")
def q_ds_handover(spark, d):
    """Label rows and the user history block handed over as tables in buckets of the
    user, and joined without an exchange."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    uid = scratch_path(spark, "x").rsplit("-", 1)[1]
    block = daygrain.b_history(b_grain(spark, d), {"train": daygrain.B_WINDOWS["train"]}, tasks=True)["user"].drop("part")
    names = [_HU + c for c in ("receive_cnt", "receive_and_consume_cnt", "receive_differ_Merchant_cnt")]
    rows = write_bucketed(tl(spark, d).select("user_id", "coupon_id", "date_received", "label"), f"handover_rows_{uid}",
                          scratch_path(spark, "handover-rows"), ["user_id"], n)
    block = write_bucketed(block.select("user_id", *names), f"handover_user_{uid}", scratch_path(spark, "handover-user"), ["user_id"], n)
    return rows.join(block, "user_id", "left").na.fill(0, names)


# nine intervals: history, middle and label of the three splits, by receipt day
_NINE = {f"{name}_{part}": (first, last) for name, part, first, last in (
    ("train", "history", "2016-03-02", "2016-04-30"), ("train", "middle", "2016-05-01", "2016-05-15"),
    ("train", "label", "2016-05-16", "2016-06-15"), ("validate", "history", "2016-01-16", "2016-03-15"),
    ("validate", "middle", "2016-03-16", "2016-03-30"), ("validate", "label", "2016-03-31", "2016-04-30"),
    ("test", "history", "2016-04-17", "2016-06-15"), ("test", "middle", "2016-06-16", "2016-06-30"),
    ("test", "label", "2016-07-01", "2016-07-31"))}


def _distinct_sql(key: str, value: str) -> str:
    return S.with_(PB) + "\nUNION ALL ".join(
        f"""SELECT '{name}' AS part, {key}, COUNT(DISTINCT {value}) AS received,
  COUNT(DISTINCT {value}) FILTER (WHERE date IS NOT NULL) AS used, COUNT(DISTINCT {value}) FILTER (WHERE label = 1) AS used_15
  FROM pb WHERE {S.between('date_received', *days)} GROUP BY {key} HAVING COUNT({value}) > 0"""
        for name, days in _NINE.items())


def _distinct_windows(spark, d, key: str, value: str) -> DataFrame:
    rows = prep.prepare_b(log(spark, d))
    marks = {"received": F.lit(True), "used": B.consumed(), "used_15": F.col("label") == 1}
    bits = daybits.day_bits(rows, [key], value, "date_received", "2016-01-01", 213, marks)
    return daybits.distinct_counts(bits, [key], "2016-01-01", 213, list(marks), _NINE)


@register("agg_distinct_merchants", _distinct_sql("user_id", "merchant_id"))
def q_agg_distinct_merchants(spark, d):
    """A3: a user's distinct merchants in nine intervals, from one table of day bitmaps."""
    return _distinct_windows(spark, d, "user_id", "merchant_id")


@register("agg_distinct_users", _distinct_sql("merchant_id", "user_id"))
def q_agg_distinct_users(spark, d):
    return _distinct_windows(spark, d, "merchant_id", "user_id")


@register("agg_median", S.with_(PB) + "\nUNION ALL ".join(
    f"SELECT '{key}' AS key, {key} AS id, CAST(MEDIAN({value}) AS DOUBLE) AS median FROM pb WHERE {where} GROUP BY {key}"
    for key, value, where in (("merchant_id", "distance", "date IS NOT NULL AND coupon_id IS NOT NULL AND distance <> -1"),
                              ("coupon_id", "min_cost_of_manjian", "is_manjian = 1 AND coupon_id IS NOT NULL"),
                              ("user_id", "coupon_id", "coupon_id IS NOT NULL"))))
def q_agg_median(spark, d):
    """A5: exact medians by counted selection, in ranges: distance of used receipts per
    merchant, minimum spend per coupon, and a user's middle coupon number."""
    rows = prep.prepare_b(log(spark, d))
    used = rows.where(B.consumed() & F.col("coupon_id").isNotNull() & (F.col("distance") != -1))
    plans = [("merchant_id", "distance", used), ("coupon_id", "min_cost_of_manjian", rows.where("is_manjian = 1 and coupon_id is not null")),
             ("user_id", "coupon_id", rows)]
    out = None
    for key, value, kept in plans:
        one = median.counted_median(median.value_counts(kept, [key], value), [key], value, ranges=8)
        one = one.select(F.lit(key).alias("key"), F.col(key).alias("id"), "median")
        out = one if out is None else out.unionByName(one)
    return out


# ====================================================================== learning
@register("scale_minmax", S.with_(
    "k AS (SELECT * FROM coupon WHERE distance IS NOT NULL)") + """SELECT user_id, coupon_id,
  distance, round(COALESCE(CAST(distance - MIN(distance) OVER () AS DOUBLE)
    / NULLIF(MAX(distance) OVER () - MIN(distance) OVER (), 0), 0.0), 6) AS distance_scaled FROM k""")
def q_scale_minmax(spark, d):
    known = log(spark, d).where(F.col("distance").isNotNull()).select(
        "user_id", "coupon_id", "distance")
    return r6(ml.min_max_scale(known, "distance", "distance_scaled"))


_MODELS: dict = {}


def _model(spark, d, family: str):
    """Fit once per session, input data and family (score and importance
    queries share the model).  The key holds the input's stamp, so changed
    tables are fitted anew."""
    from redeemflow.plans import models
    from redeemflow.sources.log import log_table_path

    lg = log(spark, d)
    key = (spark.sparkContext.applicationId, log_table_path(spark, d), family)
    if key not in _MODELS:
        fit = {"b": models.b_fit, "b-offline": models.b_offline_fit, "a": models.a_fit}[family]
        _MODELS[key] = fit(lg, grain=a_grain(spark, d) if family == "a" else b_grain(spark, d))
    model, features = _MODELS[key]
    return lg, model, features


@register("ml_score")
def q_ml_score(spark, d):
    """M1-M3 (Family B): fit on train + validate, score the July test set."""
    from redeemflow.plans import models

    lg, model, features = _model(spark, d, "b")
    return models.b_predictions(lg, model, features, b_grain(spark, d))


@register("ml_importance")
def q_ml_importance(spark, d):
    _, model, features = _model(spark, d, "b")
    return ml.importance(model, features, spark)


@register("ml_validate")
def q_ml_validate(spark, d):
    """M7: fit on the Family B train set, AUC on the validate set."""
    from redeemflow.plans import models

    lg, *fitted = _model(spark, d, "b-offline")
    return models.b_validate(lg, fitted=fitted, grain=b_grain(spark, d))


@register("ml_rounds")
def q_ml_rounds(spark, d):
    """M1/M7's watch list: AUC on the train and the validate set after every boosting
    round of the offline fit."""
    from redeemflow.plans import models

    lg, *fitted = _model(spark, d, "b-offline")
    return models.curve(models.b_watch(lg, fitted, grain=b_grain(spark, d)))


@register("ml_round_rows", S.with_(PB, _TRAIN_CTES, _VAL_CTES) + f"""SELECT part, CAST(round AS INTEGER) AS round,
  CAST(SUM(label) AS BIGINT) AS positives, CAST(COUNT(*) - SUM(label) AS BIGINT) AS negatives, TRUE AS agrees
  FROM (SELECT 'train' AS part, label FROM ({_TRAIN_SEL}) UNION ALL SELECT 'validate', label FROM ({_VAL_SEL})),
    unnest(range(1, {ml.ROUNDS + 1})) AS r(round) GROUP BY part, round""")
def q_ml_round_rows(spark, d):
    """What SQL can say of the watch list: every round judges every row of both sets; AUCs
    are in range, and the last one on the validate set is that of the whole model (but for
    scores that tie in one sum of the trees and not in the other)."""
    from redeemflow.plans import models

    lg, *fitted = _model(spark, d, "b-offline")
    whole = models.b_validate(lg, fitted=fitted, grain=b_grain(spark, d)).select("auc").scalar()
    last = (F.col("part") == "validate") & (F.col("round") == ml.ROUNDS)
    agrees = F.col("auc").between(0, 1) & (~last | (F.abs(F.col("auc") - whole) < 1e-6))
    return models.b_watch(lg, fitted, grain=b_grain(spark, d)).select("part", "round", "positives", "negatives", agrees.alias("agrees"))


@register("ml_offline_rows", S.with_(PB, _VAL_CTES) + f"""SELECT user_id, coupon_id, date_received, label,
  TRUE AS scored, COUNT(*) AS rows FROM ({_VAL_SEL}) GROUP BY ALL""")
def q_ml_offline_rows(spark, d):
    """M7's offline predictions, what SQL can say of them: ids and label of every
    validate row, and that each has a probability."""
    from redeemflow.plans import models

    lg, *fitted = _model(spark, d, "b-offline")
    scored = models.b_offline(lg, fitted, b_grain(spark, d))
    return (scored.select("user_id", "coupon_id", "date_received", "label",
                          F.coalesce(F.col("prob").between(0, 1), F.lit(False)).alias("scored"))
            .groupBy("user_id", "coupon_id", "date_received", "label", "scored").agg(F.count("*").alias("rows")))


@register("ml_prediction_files", S.with_(PB, PT, _TEST_CTES) + f"""SELECT user_id, coupon_id, date_received,
  COUNT(*) AS rows, TRUE AS scored FROM ({_TEST_SEL}) GROUP BY ALL
  UNION ALL SELECT -1, -1, NULL, 39, TRUE""")
def q_ml_prediction_files(spark, d):
    """Predictions and importances written as files and read again.  Ids
    come back as integers, probabilities in [0, 1]; the row -1 counts the features that the
    importance file is judged by, which are all: each used one is there once with its number
    of splits in the trees, most first, and the others are not."""
    from redeemflow.plans import models

    lg, model, features = _model(spark, d, "b")
    path, imp_path = scratch_path(spark, "predictions"), scratch_path(spark, "importance")
    models.write_predictions(models.b_predictions(lg, model, features, b_grain(spark, d)), path)
    models.write_importance(ml.importance(model, features, spark), imp_path)
    back = spark.read.csv(path, schema="user_id long, coupon_id long, day string, prob double", nullValue="null")
    rows = (back.groupBy("user_id", "coupon_id", F.to_date("day", "yyyyMMdd").alias("date_received"))
            .agg(F.count("*").alias("rows"), F.min(F.col("prob").between(0, 1)).alias("scored")))
    imp = spark.read.csv(imp_path, header=True, schema="feature string, score long")
    line = Window.orderBy(F.monotonically_increasing_id())  # one row per feature
    imp = imp.select("*", F.coalesce(F.lag("score").over(line) >= F.col("score"), F.lit(True)).alias("falls"))
    imp = imp.groupBy("feature").agg(F.count("*").alias("lines"), F.sum("score").alias("score"), F.min("falls").alias("falls"))
    splits = spark.createDataFrame(list(zip(features, ml.split_counts(model, len(features)))), "feature string, splits long")
    told = F.when(F.col("splits") > 0, F.col("falls") & (F.col("lines") == 1) & (F.col("score") == F.col("splits")))
    judged = splits.join(imp, "feature", "full").select(
        "splits", F.coalesce(told, F.col("splits").isNotNull() & (F.col("splits") == 0) & F.col("lines").isNull()).alias("ok"))
    total = judged.agg(F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("coupon_id"),
                       F.lit(None).cast("date").alias("date_received"), F.count("splits").alias("rows"), F.min("ok").alias("scored"))
    return rows.unionByName(total)


@register("ml_score_a")
def q_ml_score_a(spark, d):
    """M1-M4, O1 (Family A): fit on sets 1 + 2 without day gaps, score set 3,
    min-max scale, sort by (coupon_id, score)."""
    from redeemflow.plans import models

    lg, model, features = _model(spark, d, "a")
    return models.a_predictions(lg, model, features, a_grain(spark, d))


@register("ml_importance_a")
def q_ml_importance_a(spark, d):
    _, model, features = _model(spark, d, "a")
    return ml.importance(model, features, spark)


@register("ml_score_a_rows", f"""SELECT user_id, coupon_id, date_received, COUNT(*) AS rows, TRUE AS sorted
  FROM (SELECT DISTINCT * FROM ({ORACLE["a_dataset_test"]})) GROUP BY ALL
  UNION ALL SELECT -1, -1, NULL, 1, TRUE""")
def q_ml_score_a_rows(spark, d):
    """Family A's prediction files read again: ids of every row of set 3, each file
    sorted by (coupon_id, score).  The row -1 says whether the scores run from 0 to 1."""
    from redeemflow.plans import models

    lg, model, features = _model(spark, d, "a")
    path = scratch_path(spark, "predictions-a")
    models.write_predictions(models.a_predictions(lg, model, features, a_grain(spark, d)), path)
    back = spark.read.csv(path, schema="user_id long, coupon_id long, day string, score double", nullValue="null")
    back = back.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    here, pair = Window.partitionBy("file").orderBy("line"), F.struct("coupon_id", "score")
    back = back.withColumn("sorted", F.coalesce(F.lag(pair).over(here) <= pair, F.lit(True)))
    rows = (back.groupBy("user_id", "coupon_id", F.to_date("day", "yyyyMMdd").alias("date_received"))
            .agg(F.count("*").alias("rows"), F.min("sorted").alias("sorted")))
    ends = back.agg(F.lit(-1).cast("long").alias("user_id"), F.lit(-1).cast("long").alias("coupon_id"),
                    F.lit(None).cast("date").alias("date_received"), F.lit(1).cast("long").alias("rows"),
                    ((F.min("score") == 0) & (F.max("score") == 1)).alias("sorted"))
    return rows.unionByName(ends)


@register("ml_auc", S.with_(PB, TL_CTE,
                            "g AS (SELECT discount_rate AS s, COUNT(*) FILTER (WHERE label = 1) AS pos, "
                            "COUNT(*) FILTER (WHERE label <> 1) AS neg FROM tl "
                            "WHERE discount_rate IS NOT NULL GROUP BY discount_rate)",
                            "r AS (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN "
                            "UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM g)")
          + """SELECT round(SUM(pos * (nb + neg / 2.0)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6)
  AS auc, CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives FROM r""")
def q_ml_auc(spark, d):
    return r6(ml.exact_auc(tl(spark, d), "discount_rate", "label"))


_KM_CTES = [
    "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
    "c AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS cluster, v "
    "FROM e ORDER BY vec_id LIMIT 4)",
    "dist AS (SELECT e.vec_id, e.v, c.cluster, list_distance(e.v, c.v) AS distance "
    "FROM e, c)",
    "a AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, "
    "cluster) AS rk FROM dist) WHERE rk = 1)",
]


@register("kmeans_assign", "WITH " + ",\n".join(_KM_CTES)
          + "\nSELECT vec_id, cluster, round(distance, 6) AS distance FROM a")
def q_kmeans_assign(spark, d):
    pts = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    cents = kmeans.first_k(pts, 4, "vec_id")
    return r6(kmeans.assign(pts, cents).select("vec_id", "cluster", "distance"))


@register("kmeans_step", "WITH " + ",\n".join(_KM_CTES) + """,
u AS (SELECT cluster, generate_subscripts(v, 1) - 1 AS position, unnest(v) AS x FROM a)
SELECT cluster, CAST(position AS INTEGER) AS position, round(AVG(x), 6) AS mean FROM u
GROUP BY cluster, position""")
def q_kmeans_step(spark, d):
    pts = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    cents = kmeans.first_k(pts, 4, "vec_id")
    return r6(kmeans.lloyd_step(pts, cents))


# Lloyd's steps unrolled by recursion: a state is the list of centroids and every
# vector's cluster; it ends when no vector changes cluster.
_KM_FIT = """WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
    CAST(ROW_NUMBER() OVER (ORDER BY vec_id) AS INTEGER) AS i FROM embeddings),
flat AS (SELECT i, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM e),
start AS (SELECT list(v ORDER BY i) AS c FROM e WHERE i <= 4),
run(it, c, a, moved) AS (
  SELECT 0, c, CAST([] AS INTEGER[]), TRUE FROM start
  UNION ALL
  SELECT it + 1,
    CASE WHEN n.a = r.a THEN r.c ELSE (
      SELECT list(m ORDER BY k) FROM (SELECT k, list(mean ORDER BY j) AS m FROM (
        SELECT n.a[i] AS k, j, AVG(x) AS mean FROM flat GROUP BY 1, 2) GROUP BY k)) END,
    n.a, n.a <> r.a
  FROM run r, LATERAL (SELECT list(k ORDER BY i) AS a FROM (
    SELECT i, CAST(list_position(ds, list_min(ds)) AS INTEGER) AS k FROM (
      SELECT i, [list_distance(v, r.c[1]), list_distance(v, r.c[2]),
                 list_distance(v, r.c[3]), list_distance(v, r.c[4])] AS ds FROM e))) n
  WHERE r.moved),
fin AS (SELECT c FROM run ORDER BY it DESC LIMIT 1)
"""


@register("kmeans_fit", _KM_FIT.rstrip() + """,
d AS (SELECT vec_id, [list_distance(v, c[1]), list_distance(v, c[2]), list_distance(v, c[3]),
                      list_distance(v, c[4])] AS ds FROM e, fin)
SELECT vec_id, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS cluster,
  round(list_min(ds), 6) AS distance, round(list_min(ds) * list_min(ds), 6) AS sq_error FROM d""")
def q_kmeans_fit(spark, d):
    """M8: Lloyd's algorithm on the embeddings until no point changes cluster
    (k = 4, start = the 4 lowest vec_id); final assignment with squared
    errors."""
    pts = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    _, assigned = kmeans.kmeans(pts, 4, "vec_id")
    return r6(assigned.select("vec_id", "cluster", "distance", "sq_error"))


def _km_start(seed: int) -> str:
    """The unrolled fit from the start that the seed draws, its tables named for it."""
    sql = _KM_FIT.split("flat AS", 1)[1].replace(
        "list(v ORDER BY i) AS c FROM e WHERE i <= 4", "list(v ORDER BY r) AS c FROM (SELECT v, row_number() OVER "
        f"(ORDER BY md5('{seed}:' || CAST(vec_id AS VARCHAR))) AS r FROM e) WHERE r <= 4")
    for name in ("start", "run", "fin"):
        sql = re.sub(rf"\b{name}\b", f"{name}_{seed}", sql)
    return sql.split("),\n", 1)[1].rstrip()


_KM_SEEDS = (1, 2, 3)
_KM_ERRORS = "\nUNION ALL ".join(
    f"SELECT {s} AS seed, c FROM fin_{s}" for s in _KM_SEEDS)


@register("kmeans_restarts", _KM_FIT.split("start AS", 1)[0] + ",\n".join(_km_start(s) for s in _KM_SEEDS) + f""",
ends AS ({_KM_ERRORS}),
far AS (SELECT seed, vec_id, [list_distance(v, c[1]), list_distance(v, c[2]), list_distance(v, c[3]), list_distance(v, c[4])] AS ds
  FROM e, ends),
best AS (SELECT seed FROM far GROUP BY seed ORDER BY round(SUM(list_min(ds) * list_min(ds)), 6), seed LIMIT 1)
SELECT seed, vec_id, CAST(list_position(ds, list_min(ds)) - 1 AS INTEGER) AS cluster, round(list_min(ds), 6) AS distance
FROM far JOIN best USING (seed)""")
def q_kmeans_restarts(spark, d):
    """M8 from random starts: three seeds, the fit with the lowest error kept."""
    pts = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    seed, _, assigned = kmeans.restarts(pts, 4, "vec_id", list(_KM_SEEDS))
    return r6(assigned.select(F.lit(seed).alias("seed"), "vec_id", "cluster", "distance"))


@register("kmeans_matrix_file", "WITH " + ",\n".join(_KM_CTES) + """
SELECT cluster, COUNT(*) AS points, round(SUM(distance), 4) AS distance FROM a GROUP BY cluster""")
def q_kmeans_matrix_file(spark, d):
    """S5 into M8: the embeddings written as a tab-separated matrix, read by
    ``read_matrix_csv`` and assigned to the 4 lowest vec_id."""
    pts = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding")
    path = scratch_path(spark, "matrix")
    (pts.select(*[F.col("embedding")[i].cast("double").alias(f"c{i}") for i in range(64)])
        .write.option("sep", "\t").csv(path))
    matrix = read_matrix_csv(spark, path, 64)
    got = kmeans.assign(matrix, kmeans.first_k(pts, 4, "vec_id"), "features")
    return (got.groupBy("cluster").agg(F.count("*").alias("points"),
                                       F.round(F.sum("distance"), 4).alias("distance")))
