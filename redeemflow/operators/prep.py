"""Row-level preparation (P1-P21): one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow import functions as RF

DISTANCE_DOMAIN = list(range(-1, 11))
WEEKDAY0_DOMAIN = list(range(0, 7))
ISO_WEEKDAY_DOMAIN = list(range(1, 8))


def with_discount(df: DataFrame, rate: str = "discount_rate", form: str = "b",
                  min_cost_default: int = -1) -> DataFrame:
    """P1-P4 next to the raw text (the text is split once per row)."""
    parsed = df.select("*", *RF.discount_parts(rate))
    return parsed.select(
        *df.columns,
        RF.p_is_manjian().alias("is_manjian"),
        RF.p_ratio(rate, form).alias("discount_ratio"),
        RF.p_min_cost(min_cost_default).alias("min_cost_of_manjian"),
        RF.p_man().alias("discount_man"),
        RF.p_jian().alias("discount_jian"),
    )


def with_distance(df: DataFrame, d: str = "distance") -> DataFrame:
    """P5/P6."""
    return df.select("*", RF.distance_filled(d).alias("distance_filled"),
                     RF.null_distance(d).alias("null_distance"))


def with_dates(df: DataFrame) -> DataFrame:
    """ISO weekday and months of receipt and of consumption."""
    cols = ["*", RF.iso_weekday("date_received").alias("weekday_received"),
            F.month("date_received").alias("month_received")]
    if "date" in df.columns:
        cols.append(F.month("date").alias("month_consumed"))
    return df.select(*cols)


def prepare_b(df: DataFrame, min_cost_default: int = -1) -> DataFrame:
    """Family B ``prepare`` (+ ``get_label`` when ``date`` exists).

    Output: user_id, merchant_id, coupon_id, discount_text (raw),
    distance (unknown -> -1), date_received, [date], is_manjian,
    discount_rate (ratio), min_cost_of_manjian, null_distance, [label].
    """
    parsed = df.select("*", *RF.discount_parts("discount_rate"))
    cols = [
        "user_id", "merchant_id", "coupon_id",
        F.col("discount_rate").alias("discount_text"),
        RF.distance_filled("distance").alias("distance"),
        "date_received",
    ]
    has_date = "date" in df.columns
    if has_date:
        cols.append("date")
    cols += [
        RF.p_is_manjian().alias("is_manjian"),
        RF.p_ratio("discount_rate", "b").alias("discount_rate"),
        RF.p_min_cost(min_cost_default).alias("min_cost_of_manjian"),
        RF.null_distance("distance").alias("null_distance"),
    ]
    if has_date:
        cols.append(RF.label_binary("date", "date_received").alias("label"))
    return parsed.select(*cols)


def prep_all(df: DataFrame) -> DataFrame:
    """Every row-level rule chained on the raw log, plus the binary label."""
    out = df.select("*", *RF.discount_parts("discount_rate")).select(
        *df.columns,
        RF.p_is_manjian().alias("is_manjian"),
        RF.p_ratio("discount_rate", "b").alias("discount_ratio"),
        RF.p_min_cost().alias("min_cost_of_manjian"),
        RF.distance_filled("distance").alias("distance_filled"),
        RF.null_distance("distance").alias("null_distance"),
        RF.iso_weekday("date_received").alias("weekday_received"),
        F.month("date_received").alias("month_received"),
        RF.day_gap("date", "date_received").alias("days_to_use"),
    )
    if "date" in df.columns:
        out = out.select("*", F.month("date").alias("month_consumed"),
                         RF.label_binary().alias("label"))
    return out


def onehot_distance(df: DataFrame, d: str = "distance") -> DataFrame:
    """Fixed domain -1..10 over the filled distance."""
    filled = RF.distance_filled(d)
    return df.select("*", *RF.one_hot(filled, DISTANCE_DOMAIN, lambda s: f"distance_{s}"))
