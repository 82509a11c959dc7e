"""Exploratory aggregates (the data behind the reference's charts).

Every function is one aggregation over the log (partial aggregation
map-side, one shuffle of combined rows).  Totals that a result row needs
(the daily maximum, the denominator of a share) are scalar subqueries,
never windows over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from redeemflow import functions as RF


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _labelled(log: DataFrame) -> DataFrame:
    if "label" in log.columns:
        return log
    return log.select("*", RF.label_binary().alias("label"))


def profile(log: DataFrame) -> DataFrame:
    """One row of table totals."""
    return log.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("date_received").alias("receipts"),
        F.count("date").alias("purchases"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("merchant_id").alias("merchants"),
        F.count_distinct("coupon_id").alias("coupons"),
        F.min("date_received").alias("first_received"),
        F.max("date_received").alias("last_received"),
        F.min("date").alias("first_used"),
        F.max("date").alias("last_used"),
    )


def missing(log: DataFrame) -> DataFrame:
    """Per column, null count, share and whether any is null."""
    n = F.count(F.lit(1)).alias("__rows")
    counts = log.agg(n, *[F.count_if(F.col(c).isNull()).alias(c) for c in log.columns])
    long = counts.unpivot("__rows", log.columns, "column_name", "nulls")
    return long.select(
        "column_name", F.col("nulls").cast("long").alias("nulls"),
        F.try_divide(F.col("nulls").cast("double"), F.col("__rows")).alias("share"),
        (F.col("nulls") > 0).alias("any_null"))


def daily(log: DataFrame) -> DataFrame:
    """Coupons received per day, and the maximum over days."""
    g = (log.where(F.col("date_received").isNotNull())
            .groupBy("date_received").agg(F.count("coupon_id").alias("received")))
    # the maximum is a scalar subquery over the daily counts (one partial
    # row per task), not a window that would gather the rows in one task
    return g.select("*", g.select(F.max("received")).scalar().alias("max_received"))


def distance_counts(log: DataFrame) -> DataFrame:
    """Rows per known distance."""
    return (log.where(F.col("distance").isNotNull())
               .groupBy("distance").agg(F.count(F.lit(1)).alias("rows")))


def distance_rate(log: DataFrame) -> DataFrame:
    """Redemption rate (binary label) per known distance; 0 where none."""
    lab = _labelled(log)
    return (lab.where(F.col("distance").isNotNull())
               .groupBy("distance")
               .agg(F.avg(F.col("label").cast("double")).alias("rate"),
                    F.count(F.lit(1)).alias("rows"),
                    _count_if(F.col("label") == 1).alias("redeemed")))


def discount_counts(log: DataFrame) -> DataFrame:
    """Received and redeemed per discount ratio, 0 where none redeemed."""
    lab = (_labelled(log).select("discount_rate", "label", *RF.discount_parts())
           .select(RF.p_ratio().alias("ratio"), "label"))
    return (lab.where(F.col("ratio").isNotNull())
               .groupBy("ratio")
               .agg(F.count(F.lit(1)).alias("received"),
                    _count_if(F.col("label") == 1).alias("redeemed")))


def monthly(log: DataFrame) -> DataFrame:
    """E5: per month -- redeemed and received by receive month, consumed by
    consume month, 0 where a month between the first and the last has none.
    One pass: each row contributes to (at most) two months."""
    lab = _labelled(log)
    events = lab.select(F.explode(F.array(
        F.struct(F.month("date_received").alias("month"),
                 F.col("date_received").isNotNull().cast("int").alias("rec"),
                 F.when(F.col("label") == 1, 1).otherwise(0).alias("red"),
                 F.lit(0).alias("con")),
        F.struct(F.month("date").alias("month"), F.lit(0).alias("rec"), F.lit(0).alias("red"),
                 F.lit(1).alias("con")),
    )).alias("e")).select("e.*")
    months = (events.where(F.col("month").isNotNull())
                    .groupBy("month")
                    .agg(F.sum("red").cast("long").alias("redeemed"),
                         F.sum("rec").cast("long").alias("received"),
                         F.sum("con").cast("long").alias("consumed")))
    return _between_ends(months)


def _between_ends(months: DataFrame) -> DataFrame:
    """``months`` (``month`` and counts, 12 rows at most) with zeros for the months between the
    first and the last that it lacks.  Zero rows of all twelve are added and the ends
    found among the sums, so ``months`` is computed once."""
    names = [c for c in months.columns if c != "month"]
    zero = months.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"),
                                                   *[F.lit(0).cast("long").alias(c) for c in names], F.lit(0).alias("_has"))
    both = months.select("month", *names, F.lit(1).alias("_has")).unionByName(zero)
    sums = both.groupBy("month").agg(*[F.sum(c).alias(c) for c in names], F.max("_has").alias("_has"))
    ends = Window.partitionBy()  # twelve rows
    there = F.when(F.col("_has") == 1, F.col("month"))
    sums = sums.select("*", F.min(there).over(ends).alias("_lo"), F.max(there).over(ends).alias("_hi"))
    return sums.where("month between _lo and _hi").select("month", *names)


def _on_axis(axis: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Every key of ``axis`` with its counts, 0 where there are none."""
    return axis.join(counts, key, "left").na.fill(0, [c for c in counts.columns if c != key])


def weekday(log: DataFrame) -> DataFrame:
    """Receipts and redemptions per ISO weekday of receipt, all seven days."""
    lab = _labelled(log)
    days = (lab.where(F.col("date_received").isNotNull())
               .groupBy(RF.iso_weekday("date_received").alias("weekday"))
               .agg(F.count(F.lit(1)).alias("received"),
                    _count_if(F.col("label") == 1).alias("redeemed")))
    axis = log.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("weekday"))
    return _on_axis(axis, days, "weekday")


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts keyed by value (not by frequency rank)."""
    kept = df.where(F.col(col).isNotNull())
    g = kept.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
    total = kept.select(F.count(F.lit(1))).scalar()
    return g.select("*", (F.col("rows") / total).alias("share"))


def type_share(log: DataFrame, redeemed_only: bool = False) -> DataFrame:
    """Manjian vs plain among receipts (or among redeemed)."""
    lab = _labelled(log)
    rows = lab.where(F.col("date_received").isNotNull())
    if redeemed_only:
        rows = lab.where(F.col("label") == 1)
    return value_shares(rows.select(RF.is_manjian("discount_rate").alias("is_manjian")), "is_manjian")


def label_share(log: DataFrame) -> DataFrame:
    """E9."""
    return value_shares(_labelled(log).select("label"), "label")


def distance_discount(log: DataFrame, distances=(0, 4, 8, 10)) -> DataFrame:
    """Receipts per (distance, discount ratio) at chosen distances."""
    rows = (log.where(F.col("distance").isin(*distances))
               .select("distance", "discount_rate", *RF.discount_parts())
               .select("distance", RF.p_ratio().alias("ratio")))
    return (rows.where(F.col("ratio").isNotNull())
                .groupBy("distance", "ratio").agg(F.count(F.lit(1)).alias("rows")))


# ------------------------------------------------------------- all charts at once
_DIMS = ["user_id", "merchant_id", "coupon_id", "date_received", "date", "distance", "ratio", "month_received",
         "month_used", "weekday", "is_manjian", "label"]
_SETS = [[], *[[d] for d in _DIMS], ["distance", "ratio"]]
#: set of dimensions -> grouping id: a bit per dimension that is not grouped by
_GROUP = {tuple(s): sum(1 << (len(_DIMS) - 1 - i) for i, d in enumerate(_DIMS) if d not in s) for s in _SETS}


def all_counts(log: DataFrame) -> DataFrame:
    """The log aggregated by every chart's key in one pass (GROUPING SETS): the keys, their
    grouping id ``g``, and ``n, received, with_coupon, redeemed``, with the null counts
    of the log's columns on the row of the whole.  ``charts`` reads its tables from this one."""
    lab = _labelled(log).select("*", *RF.discount_parts("discount_rate"))
    rows = lab.select(
        "user_id", "merchant_id", "coupon_id", "date_received", "date", "distance", RF.p_ratio("discount_rate", "b").alias("ratio"),
        F.month("date_received").alias("month_received"), F.month("date").alias("month_used"),
        RF.iso_weekday("date_received").alias("weekday"), RF.is_manjian("discount_rate").alias("is_manjian"), "label",
        F.col("date_received").isNotNull().alias("_received"), F.col("coupon_id").isNotNull().alias("_coupon"),
        (F.col("label") == 1).alias("_redeemed"), *[F.col(c).isNull().alias(f"_null_{c}") for c in log.columns])
    return rows.groupingSets([[F.col(d) for d in s] for s in _SETS], *[F.col(d) for d in _DIMS]).agg(
        F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"), F.count_if("_received").alias("received"),
        F.count_if("_coupon").alias("with_coupon"), F.count_if("_redeemed").alias("redeemed"),
        *[F.count_if(f"_null_{c}").alias(f"null_{c}") for c in log.columns])


def charts(counts: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """The twelve tables of this module from ``all_counts`` (stored once by the caller);
    ``columns`` are the log's.  Same rows and columns as the single functions."""
    def by(*keys):
        rows = counts.where(F.col("g") == _GROUP[keys])
        for k in keys:
            rows = rows.where(F.col(k).isNotNull())
        return rows

    def shares(rows, key, n):
        rows = rows.where(F.col(n) > 0)
        total = rows.select(F.sum(n)).scalar()
        return rows.select(key, F.col(n).alias("rows"), (F.col(n) / total).alias("share"))
    whole = by()
    ends = {"date_received": ("first_received", "last_received"), "date": ("first_used", "last_used")}
    profile_row = whole.select(
        F.col("n").alias("rows"), F.col("received").alias("receipts"), (F.col("n") - F.col("null_date")).alias("purchases"),
        *[by(f"{k}_id").select(F.count(F.lit(1))).scalar().alias(f"{k}s") for k in ("user", "merchant", "coupon")],
        *[by(k).select(f(k)).scalar().alias(name) for k, names in ends.items() for f, name in zip((F.min, F.max), names)])
    nulls = whole.select("n", *[F.col(f"null_{c}").alias(c) for c in columns]).unpivot("n", columns, "column_name", "nulls")
    day = by("date_received").select("date_received", F.col("with_coupon").alias("received"))
    months = (by("month_received").select(F.col("month_received").alias("month"), "redeemed", "received", F.lit(0).cast("long").alias("consumed"))
              .unionByName(by("month_used").select(F.col("month_used").alias("month"), F.lit(0).cast("long").alias("redeemed"),
                                                   F.lit(0).cast("long").alias("received"), F.col("n").alias("consumed")))
              .groupBy("month").agg(*[F.sum(c).alias(c) for c in ("redeemed", "received", "consumed")]))
    axis = counts.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("weekday"))
    return {
        "profile": profile_row,
        "missing": nulls.select("column_name", "nulls", F.try_divide(F.col("nulls").cast("double"), F.col("n")).alias("share"),
                                (F.col("nulls") > 0).alias("any_null")),
        "daily": day.select("*", day.select(F.max("received")).scalar().alias("max_received")),
        "distance_counts": by("distance").select("distance", F.col("n").alias("rows")),
        "distance_rate": by("distance").select("distance", (F.col("redeemed") / F.col("n")).alias("rate"), F.col("n").alias("rows"), "redeemed"),
        "discount_counts": by("ratio").select("ratio", F.col("n").alias("received"), "redeemed"),
        "monthly": _between_ends(months),
        "weekday": _on_axis(axis, by("weekday").select("weekday", F.col("n").alias("received"), "redeemed"), "weekday"),
        "type_share": shares(by("is_manjian"), "is_manjian", "received"),
        "type_share_redeemed": shares(by("is_manjian"), "is_manjian", "redeemed"),
        "label_share": shares(by("label"), "label", "n"),
        "distance_discount": by("distance", "ratio").where(F.col("distance").isin(0, 4, 8, 10)).select("distance", "ratio", F.col("n").alias("rows")),
    }
