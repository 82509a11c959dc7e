"""Column expressions for the row-level rules (JVM-side, codegen-friendly).

All rules are written for Spark's ANSI mode: ``try_cast``, ``try_divide``
and ``get`` never raise on odd input, they yield null instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference key names used inside feature-name prefixes (fixed values).
KEY_TITLES = {
    "user_id": "User_id",
    "merchant_id": "Merchant_id",
    "coupon_id": "Coupon_id",
    "date_received": "Date_received",
}


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lit_date(s: str) -> Column:
    return F.lit(s).cast("date")


# ---------------------------------------------------------------- discount
def is_manjian(rate) -> Column:
    """1 when the text is ``X:Y``; null text counts as plain (0)."""
    return F.coalesce(c(rate).contains(":").cast("int"), F.lit(0))


# Parsed once: project ``discount_parts`` first, then derive every discount
# column from ``_dm`` / ``_dx`` / ``_dy``.  Catalyst keeps the two
# projections apart (it does not inline a split used several times), so the
# text is split once per row instead of once per derived column.
PARTS = ("_dm", "_dx", "_dy")


def discount_parts(rate="discount_rate") -> list[Column]:
    p = F.split(c(rate), ":")
    return [c(rate).contains(":").alias("_dm"),
            F.get(p, 0).try_cast("double").alias("_dx"),
            F.get(p, 1).try_cast("double").alias("_dy")]


def p_is_manjian() -> Column:
    return F.coalesce(F.col("_dm").cast("int"), F.lit(0))


def p_ratio(rate="discount_rate", form: str = "b") -> Column:
    x, y = F.col("_dx"), F.col("_dy")
    manjian = F.try_divide(x - y, x) if form == "b" else F.lit(1.0) - F.try_divide(y, x)
    return F.when(F.col("_dm"), manjian).otherwise(c(rate).try_cast("double"))


def p_min_cost(default: int = -1) -> Column:
    return F.when(F.col("_dm"), F.col("_dx").cast("int")).otherwise(F.lit(default))


def p_man() -> Column:
    return F.when(F.col("_dm"), F.col("_dx").cast("int"))


def p_jian() -> Column:
    return F.when(F.col("_dm"), F.col("_dy").cast("int"))


# ---------------------------------------------------------------- distance
def distance_filled(d="distance") -> Column:
    """P5: unknown distance -> -1."""
    return F.coalesce(c(d), F.lit(-1))


def null_distance(d="distance") -> Column:
    """P6."""
    return c(d).isNull().cast("int")


# ---------------------------------------------------------------- dates
def iso_weekday(d) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(c(d)) + 1


def weekday0(d) -> Column:
    """Monday 0 .. Sunday 6."""
    return F.weekday(c(d))


def is_weekend(d) -> Column:
    """P10."""
    return F.weekday(c(d)).isin(5, 6).cast("int")


def day_gap(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(c(later), c(earlier))


# ---------------------------------------------------------------- labels
REDEEM_DAYS = 15


def label_binary(date="date", date_received="date_received", days: int = REDEEM_DAYS) -> Column:
    """1 when consumed at most ``days`` days after receipt (a negative gap
    counts too); a missing date gives 0."""
    return F.when(F.datediff(c(date), c(date_received)) <= days, 1).otherwise(0)


def label_threeway(date="date", date_received="date_received", days: int = REDEEM_DAYS) -> Column:
    """0 never consumed, 1 within ``days``, -1 later."""
    gap = F.datediff(c(date), c(date_received))
    return (F.when(c(date).isNull() | c(date_received).isNull(), 0)
             .when(gap <= days, 1)
             .otherwise(-1))


def label_for_training(label="label") -> Column:
    """-1 -> 0."""
    return F.when(c(label) == -1, 0).otherwise(c(label))


# ---------------------------------------------------------------- ratios
def rate_zero(num, den) -> Column:
    """Family B rule: x / y, and 0 when y is 0 or null."""
    return F.coalesce(F.try_divide(c(num).cast("double"), c(den)), F.lit(0.0))


def rate_null(num, den) -> Column:
    """Family A rule: x / y, null when y is null or 0."""
    return F.try_divide(c(num).cast("double"), c(den))


def prefix(field: str, keys: list[str]) -> str:
    """``'<field>_' + '_'.join(keys) + '_'`` with the reference key titles."""
    return f"{field}_" + "_".join(KEY_TITLES.get(k, k) for k in keys) + "_"


def one_hot(col, values, name) -> list[Column]:
    """Fixed-domain one-hot (P20/P21): one INT column per value, 0/1."""
    out = []
    for v in values:
        suffix = f"neg{abs(v)}" if isinstance(v, int) and v < 0 else str(v)
        out.append(F.coalesce((c(col) == F.lit(v)).cast("int"), F.lit(0)).alias(name(suffix)))
    return out
