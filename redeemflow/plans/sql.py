"""DuckDB text of the ``coupon`` view and of the row-level rules, used by
the oracle SQL of every query (the checker registers the driver tables
as views; everything else is built here as CTEs)."""

from __future__ import annotations

COUPON_CTES = """b AS (
  SELECT o_custkey AS user_id, l_suppkey % 25 AS merchant_id,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_partkey % 50 END AS coupon_id,
    CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN NULL
         ELSE CAST(l_quantity AS INTEGER) % 11 END AS distance,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 213 AS off,
    (l_orderkey + l_partkey) % 31 AS gap,
    l_linenumber = 7 AS plain,
    (l_orderkey + 3 * l_linenumber + l_partkey) % 4 = 0 AS used
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
coupon AS (
  SELECT user_id, merchant_id, coupon_id,
    CASE coupon_id % 5 WHEN 0 THEN '0.95' WHEN 1 THEN '30:5' WHEN 2 THEN '100:10'
                       WHEN 3 THEN '20:5' WHEN 4 THEN '200:20' END AS discount_rate,
    distance,
    CASE WHEN plain THEN NULL ELSE DATE '2016-01-01' + CAST(off AS INTEGER) END AS date_received,
    CASE WHEN plain THEN DATE '2016-01-01' + CAST(off AS INTEGER)
         WHEN used THEN DATE '2016-01-01' + CAST(off + gap AS INTEGER) END AS date
  FROM b)"""


def with_(*ctes: str) -> str:
    """``WITH`` clause: the coupon view followed by ``ctes``."""
    return "WITH " + ",\n".join((COUPON_CTES,) + ctes) + "\n"


def x_(r: str) -> str:
    return f"TRY_CAST(split_part({r}, ':', 1) AS DOUBLE)"


def y_(r: str) -> str:
    return f"TRY_CAST(split_part({r}, ':', 2) AS DOUBLE)"


def is_manjian(r: str = "discount_rate") -> str:
    return f"COALESCE(CAST(contains({r}, ':') AS INTEGER), 0)"


def ratio_b(r: str = "discount_rate") -> str:
    return (f"CASE WHEN contains({r}, ':') THEN ({x_(r)} - {y_(r)}) / {x_(r)} "
            f"ELSE TRY_CAST({r} AS DOUBLE) END")


def ratio_a(r: str = "discount_rate") -> str:
    return (f"CASE WHEN contains({r}, ':') THEN 1.0 - {y_(r)} / {x_(r)} "
            f"ELSE TRY_CAST({r} AS DOUBLE) END")


def min_cost(r: str = "discount_rate", default: int = -1) -> str:
    return f"CASE WHEN contains({r}, ':') THEN CAST({x_(r)} AS INTEGER) ELSE {default} END"


def man(r: str = "discount_rate") -> str:
    return f"CASE WHEN contains({r}, ':') THEN CAST({x_(r)} AS INTEGER) END"


def jian(r: str = "discount_rate") -> str:
    return f"CASE WHEN contains({r}, ':') THEN CAST({y_(r)} AS INTEGER) END"


def days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


def label_b(d: str = "date", r: str = "date_received") -> str:
    return f"CASE WHEN date_diff('day', {r}, {d}) <= 15 THEN 1 ELSE 0 END"


def label_a(d: str = "date", r: str = "date_received") -> str:
    return (f"CASE WHEN {d} IS NULL OR {r} IS NULL THEN 0 "
            f"WHEN date_diff('day', {r}, {d}) <= 15 THEN 1 ELSE -1 END")


def isodow(d: str) -> str:
    return f"CAST(isodow({d}) AS INTEGER)"


def wd0(d: str) -> str:
    return f"CAST(isodow({d}) - 1 AS INTEGER)"


def month(d: str) -> str:
    return f"CAST(month({d}) AS INTEGER)"


def rate_zero(n: str, d: str) -> str:
    return f"COALESCE(CAST({n} AS DOUBLE) / NULLIF({d}, 0), 0.0)"


def rate_null(n: str, d: str) -> str:
    return f"CAST({n} AS DOUBLE) / NULLIF({d}, 0)"


def half_open(col: str, start: str, end: str) -> str:
    return f"{col} >= DATE '{start}' AND {col} < DATE '{end}'"


def between(col: str, first: str, last: str) -> str:
    return f"{col} BETWEEN DATE '{first}' AND DATE '{last}'"


# Family B prepared rows (prepare + get_label), as a CTE body over ``src``.
def prep_b(src: str, with_date: bool = True) -> str:
    date_cols = "date, " if with_date else ""
    lab = f", {label_b()} AS label" if with_date else ""
    return (f"SELECT user_id, merchant_id, coupon_id, discount_rate AS discount_text, "
            f"COALESCE(distance, -1) AS distance, date_received, {date_cols}"
            f"{is_manjian()} AS is_manjian, {ratio_b()} AS discount_rate, "
            f"{min_cost()} AS min_cost_of_manjian, CAST(distance IS NULL AS INTEGER) AS null_distance"
            f"{lab} FROM {src}")


TEST_WHERE = half_open("date_received", "2016-07-01", "2016-08-01")
