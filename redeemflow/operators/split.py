"""Time splits (F1, F2).  Plain range predicates on DATE columns, so they
push down to the Parquet scan (row-group min/max) and, when the stored log
is partitioned by receive month, prune whole directories."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow.functions import lit_date
from redeemflow.sources.log import TEST_END, TEST_START  # noqa: F401


def _plus(start: str, days: int) -> str:
    return (dt.date.fromisoformat(start) + dt.timedelta(days=days)).isoformat()


def half_open(df: DataFrame, col: str, start: str, days: int) -> DataFrame:
    """``col`` in [start, start + days)."""
    return df.where((F.col(col) >= lit_date(start)) & (F.col(col) < lit_date(_plus(start, days))))


def closed(df: DataFrame, col: str, first: str, last: str) -> DataFrame:
    """Both ends inclusive."""
    return df.where(F.col(col).between(lit_date(first), lit_date(last)))


def feature_window(df: DataFrame, first: str, last: str) -> DataFrame:
    """F2 feature window: consumed in [first, last], or never consumed and
    received in [first, last].

    The exact predicate is on ``coalesce(date, date_received)``, which a
    Parquet scan cannot use; the OR of the two plain ranges is implied by it
    (a superset), so adding it changes no result but lets the scan skip row
    groups by their min/max statistics."""
    lo, hi = lit_date(first), lit_date(last)
    prefilter = F.col("date").between(lo, hi) | F.col("date_received").between(lo, hi)
    return df.where(prefilter & F.coalesce(F.col("date"), F.col("date_received")).between(lo, hi))


# Family B intervals (start, length in days); all 2016.
@dataclass(frozen=True)
class BSplit:
    history: tuple[str, int]
    middle: tuple[str, int]
    label: tuple[str, int] | None  # None: the whole test table


B_SPLITS = {
    "train": BSplit(("2016-03-02", 60), ("2016-05-01", 15), ("2016-05-16", 31)),
    "validate": BSplit(("2016-01-16", 60), ("2016-03-16", 15), ("2016-03-31", 31)),
    "test": BSplit(("2016-04-17", 60), ("2016-06-16", 15), None),
}


def b_fields(train_log: DataFrame, name: str, test_log: DataFrame | None = None):
    """(history, middle, label) DataFrames of one Family B split."""
    s = B_SPLITS[name]
    history = half_open(train_log, "date_received", *s.history)
    middle = half_open(train_log, "date", *s.middle)
    if s.label is None:
        if test_log is None:
            raise ValueError("the test split labels the test table; pass test_log")
        label = test_log
    else:
        label = half_open(train_log, "date_received", *s.label)
    return history, middle, label


# Family A sets: (dataset first, last by date_received; feature first, last; anchor)
@dataclass(frozen=True)
class ASet:
    data: tuple[str, str] | None  # None: the test table
    features: tuple[str, str]
    anchor: str


A_SETS = {
    1: ASet(("2016-04-14", "2016-05-14"), ("2016-01-01", "2016-04-13"), "2016-04-13"),
    2: ASet(("2016-05-15", "2016-06-15"), ("2016-02-01", "2016-05-14"), "2016-05-14"),
    3: ASet(None, ("2016-03-15", "2016-06-30"), "2016-06-30"),
}


def a_fields(train_log: DataFrame, n: int, test_log: DataFrame | None = None):
    """(dataset, features) of Family A set ``n``."""
    s = A_SETS[n]
    features = feature_window(train_log, *s.features)
    if s.data is None:
        if test_log is None:
            raise ValueError("set 3 uses the test table; pass test_log")
        data = test_log
    else:
        data = closed(train_log, "date_received", *s.data)
    return data, features
