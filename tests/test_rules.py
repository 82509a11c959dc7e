"""Restated-rule checks: the window-free receipt statistics against a plain
Python statement of the reference's rules, on random small tables."""

import datetime as dt
import random
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import log_df
from redeemflow.operators import blocks_a as A
from redeemflow.operators import prep
from redeemflow.plans import assemble

receipts = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(0, 9)),  # user, coupon, day offset
    min_size=1, max_size=25)


def brute_other(rows):
    """Reference rules written out: counts, first/last flags, gaps."""
    by_u = Counter(u for u, c, x in rows)
    by_uc = defaultdict(list)
    for u, c, x in rows:
        by_uc[(u, c)].append(x)
    by_ud = Counter((u, x) for u, c, x in rows)
    by_ucd = Counter(rows)
    out = {}
    for (u, c, x) in set(rows):
        days = by_uc[(u, c)]
        if len(days) > 1:
            last = 1 if max(days) - x == 0 else 0
            first = 1 if x - min(days) == 0 else 0
        else:
            last = first = -1
        before = [x - y for y in days if x - y > 0]
        after = [y - x for y in days if y - x > 0]
        out[(u, c, x)] = (len(days), by_u[u], last, first, by_ud[(u, x)], by_ucd[(u, c, x)],
                          min(before) if before else -1, min(after) if after else -1)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(receipts)
def test_other_features_match_rules(spark, rows):
    base = dt.date(2016, 5, 15)
    data = [(u, 1, c, "0.95", 1, f"{(base + dt.timedelta(x)).month:02d}-"
             f"{(base + dt.timedelta(x)).day:02d}", None) for u, c, x in rows]
    got = {}
    for r in A.other_features(log_df(spark, data)).collect():
        x = (r.date_received - base).days
        got[(r.user_id, r.coupon_id, x)] = tuple(r)[3:]
    assert got == brute_other(rows)


def test_family_a_dataset_rows_are_distinct_before_drop(spark):
    """Dedupe happens before the id columns are dropped; the dataset keeps one
    row per distinct source row."""
    random.seed(3)
    rows = []
    for _ in range(60):
        u, c = random.randint(1, 4), random.randint(1, 3)
        day = random.randint(15, 31)
        used = random.choice([None, f"06-{random.randint(1, 20):02d}"])
        rows.append((u, random.randint(1, 2), c, "30:5", random.randint(0, 3), f"05-{day:02d}", used))
    rows += rows[:10]  # exact duplicates
    lg = log_df(spark, rows)
    out = assemble.a_dataset(lg, 2)
    data, _ = __import__("redeemflow.operators.split", fromlist=["a_fields"]).a_fields(lg, 2)
    assert out.count() == data.distinct().count()


def test_label_threeway_matches_rule(spark):
    random.seed(5)
    rows, expect = [], []
    for _ in range(40):
        rec = random.randint(1, 25)
        gap = random.choice([None, -3, 0, 15, 16, 20])
        use = None if gap is None else f"06-{rec + gap:02d}" if 1 <= rec + gap <= 30 else None
        rows.append((1, 1, 1, "0.95", 1, f"06-{rec:02d}", use))
        if use is None:
            expect.append(0)
        else:
            expect.append(1 if gap <= 15 else -1)
    from redeemflow import functions as RF
    got = [r[0] for r in log_df(spark, rows).select(RF.label_threeway()).collect()]
    assert got == expect


def test_prepare_b_keeps_rows(spark):
    rows = [(1, 1, 1, "20:5", None, "05-01", None), (2, 1, None, None, 3, None, "05-02")]
    out = prep.prepare_b(log_df(spark, rows)).collect()
    assert [(r.distance, r.null_distance, r.min_cost_of_manjian) for r in out] == [
        (-1, 1, 20), (3, 0, -1)]
