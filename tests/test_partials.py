"""Day-grain partials, counted medians, day bitmaps, hand-over tables, quarantine, daily tables, one-pass charts and
random starts."""

import os
import random
import statistics
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import log_df
from redeemflow.operators import blocks_a as A
from redeemflow.operators import blocks_b as B
from redeemflow.operators import daybits, daygrain, eda, kmeans, prep, split
from redeemflow.operators.median import counted_median, value_counts
from redeemflow.session import scratch_path
from redeemflow.sources import (coupon_log, open_bucketed, read_by_day, read_log_checked, read_log_csv, write_bucketed,
                                write_by_day)


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ medians
@pytest.mark.parametrize("ranges", [None, 1, 7, 50])
def test_median_of_counts(spark, ranges):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None, "c"]), rng.choice([1.5, -2.0, 7.25, 7.25, 100.0, None, rng.random()])) for _ in range(900)]
    data += [("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = {r.k: r["median"] for r in counted_median(value_counts(df, ["k"], "v"), ["k"], "v", ranges=ranges).collect()}
    want = {}
    for k, v in data:
        if v is not None:
            want.setdefault(k, []).append(v)
    assert got == {k: pytest.approx(statistics.median(v)) for k, v in want.items()}


def test_median_of_a_key_with_a_third_of_the_rows_and_distinct_values(spark):
    n = 30_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"),
                               (F.col("id") * 7919 % n).cast("double").alias("v"))
    counts = value_counts(df, ["k"], "v")
    got = {r.k: r["median"] for r in counted_median(counts, ["k"], "v", ranges=20).collect()}
    want = {}
    for i in range(n):
        want.setdefault(0 if i % 3 == 0 else i % 500 + 1, []).append(float(i * 7919 % n))
    assert got == {k: statistics.median(v) for k, v in want.items()}


def test_median_of_nothing(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert counted_median(value_counts(empty, ["k"], "v"), ["k"], "v", ranges=4).count() == 0


# ------------------------------------------------------------------ bitmaps
def test_day_bits_merge_and_answer_every_window(spark):
    rng = random.Random(3)
    data = [(rng.randint(1, 6), rng.choice([None, 1, 2, 3, 4, 5]), f"2016-0{rng.randint(1, 7)}-{rng.randint(10, 28)}", rng.random() < 0.4)
            for _ in range(700)]
    df = spark.createDataFrame(data, "k int, v int, d string, used boolean").withColumn("d", F.to_date("d"))
    marks = {"any": F.lit(True), "used": F.col("used")}
    windows = {"all": ("2016-01-01", "2016-07-31"), "edge": ("2016-03-04", "2016-03-05"), "word": ("2016-03-05", "2016-05-08"),
               "day": ("2016-06-15", "2016-06-15"), "beyond": ("2015-01-01", "2016-01-20"), "none": ("2017-01-01", "2017-02-01")}
    early, late = df.where("d < '2016-04-01'"), df.where("d >= '2016-04-01'")
    whole = daybits.day_bits(df, ["k"], "v", "d", "2016-01-01", 213, marks)
    merged = daybits.merge_bits(["k"], "v", *[daybits.day_bits(x, ["k"], "v", "d", "2016-01-01", 213, marks) for x in (early, late)])
    assert rows(whole) == rows(merged)
    got = {(r.k, r.part): (r["any"], r.used) for r in daybits.distinct_counts(merged, ["k"], "2016-01-01", 213, ["any", "used"], windows).collect()}
    want = {}
    for name, (first, last) in windows.items():
        for k in range(1, 7):
            inside = [(v, u) for kk, v, d, u in data if kk == k and v is not None and first <= d <= last]
            if inside:
                want[k, name] = (len({v for v, _ in inside}), len({v for v, u in inside if u}))
    assert got == want


# ------------------------------------------------------------------ partials
def test_partials_equal_the_single_blocks(spark):
    lg = coupon_log(spark, SF_SMALL)
    grain = daygrain.a_grain(lg)
    single = {"merchant": A.merchant_features, "user": A.user_features, "user_merchant": A.user_merchant_features}
    for name, block in single.items():
        got = getattr(daygrain, f"a_{name}")(grain)
        for n in (1, 2, 3):
            want = block(split.feature_window(lg, *split.A_SETS[n].features))
            assert rows(got.where(F.col("part") == f"set{n}").drop("part").select(want.columns)) == rows(want), (name, n)
    prepared = prep.prepare_b(lg)
    grain = daygrain.b_grain(prepared)
    for name in ("user", "merchant", "coupon", "user_coupon", "user_ext"):
        label = split.half_open(prepared, "date_received", "2016-03-31", 31)
        history = split.half_open(prepared, "date_received", "2016-01-16", 60)
        want = getattr(B, f"hist_{name}")(label, history)
        got = daygrain.hist(name, label.select(F.lit("validate").alias("part"), "*"), grain)
        assert rows(got.drop("part").select(want.columns)) == rows(want), name


def test_partials_of_days_add_up(spark):
    """Partials of two halves of a log, by day, are together those of the log."""
    lg = coupon_log(spark, SF_SMALL)
    cut = F.coalesce("date", "date_received") < F.lit("2016-03-20").cast("date")
    halves = daygrain.a_grain(lg.where(cut)).unionByName(daygrain.a_grain(lg.where(~cut)))
    whole = daygrain.a_grain(lg)
    assert rows(halves) == rows(whole)
    assert rows(daygrain.a_user(halves)) == rows(daygrain.a_user(whole))


def test_all_sets_read_the_log_once(spark):
    lg = coupon_log(spark, SF_SMALL)
    for df in (daygrain.a_user_merchant(daygrain.a_grain(lg)), daygrain.a_merchant(daygrain.a_grain(lg))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1


# ------------------------------------------------------------------ hand-over tables
def test_bucketed_tables_join_without_an_exchange(spark):
    lg = coupon_log(spark, SF_SMALL)
    left = lg.select("user_id", "coupon_id", "date_received")
    right = lg.groupBy("user_id").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "bucketed")
    a = write_bucketed(left, "ho_rows", scratch_path(spark, "bucketed-rows"), ["user_id"], 6)
    b = write_bucketed(right, "ho_user", path, ["user_id"], 6)
    for other in (b, open_bucketed(spark, "ho_user_again", path, right.schema, ["user_id"], 6)):
        joined = a.join(other, "user_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
        assert rows(joined) == rows(left.join(right, "user_id"))


# ------------------------------------------------------------------ quarantine
LINES = ["user_id,merchant_id,coupon_id,discount_rate,distance,date_received,date", "1,2,null,null,0,null,20160217", "3,4,11002,150:20,1,20160528.0,null",
         "5,6,x7,0.9,2,20160601,null", "5,6,7,0.9,two,20161301,20160603", "8,9,10", "1,2,3,0.9,1,20160601,null,extra", "null,6,7,0.9,2,20160601,null",
         "", "7,,8,0.95,null,20160601,"]


def test_quarantine_holds_what_is_no_row(spark):
    folder = tempfile.mkdtemp(prefix="rf-quarantine-")
    for k in (0, 1):
        with open(os.path.join(folder, f"p{k}.csv"), "w") as f:
            f.write("\n".join(LINES) + "\n")
    good, rejected = read_log_checked(spark, folder)
    assert good.count() + rejected.count() == 2 * (len(LINES) - 2)  # no header, no empty line
    assert sorted((r.line, r.reason) for r in rejected.collect()) == sorted(2 * [
        (LINES[3], "coupon_id"), (LINES[4], "distance,date_received"), (LINES[5], "columns"), (LINES[6], "columns"),
        (LINES[7], "no user_id"), (LINES[9], "no merchant_id")])
    assert {os.path.basename(r.file) for r in rejected.collect()} == {"p0.csv", "p1.csv"}
    assert rows(good.distinct()) == rows(read_log_csv(spark, folder).where("user_id in (1, 3) and coupon_id is distinct from 3").distinct())
    strict, _ = read_log_checked(spark, folder, strict=True)
    with pytest.raises(Exception, match="rejected line"):
        strict.collect()


def test_quarantine_of_clean_and_empty_files(spark):
    folder = tempfile.mkdtemp(prefix="rf-clean-")
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("\n".join(LINES[:3]) + "\n")
    strict, rejected = read_log_checked(spark, folder, strict=True)
    assert strict.count() == 2 and rejected.count() == 0
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write("")
    assert [x.count() for x in read_log_checked(spark, folder)] == [0, 0]


# ------------------------------------------------------------------ days
def test_a_day_can_be_written_again(spark):
    data = [(1, 1, 1, "30:5", 1, "05-20", None), (2, 1, 1, "30:5", 1, "05-20", "05-21"), (3, 1, None, None, 1, None, "05-21"),
            (4, 2, 2, "0.9", None, "05-22", None)]
    lg, day = log_df(spark, data), F.coalesce("date_received", "date")
    path = scratch_path(spark, "by-day")
    write_by_day(lg, path, day)
    for _ in range(2):
        write_by_day(lg.where(day == F.lit("2016-05-20").cast("date")), path, day)
        assert rows(read_by_day(spark, path)) == rows(lg)
    write_by_day(log_df(spark, [(9, 9, 9, "0.9", 9, "05-22", None)]), path, day)
    assert [r.user_id for r in read_by_day(spark, path).orderBy("user_id").collect()] == [1, 2, 3, 9]
    some = read_by_day(spark, path, "2016-05-21", "2016-05-21")
    assert [r.user_id for r in some.collect()] == [3]
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ charts
def test_one_pass_gives_all_charts(spark):
    lg = coupon_log(spark, SF_SMALL)
    counts = eda.all_counts(lg)
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    path = scratch_path(spark, "counts")
    counts.write.parquet(path)
    single = {"type_share_redeemed": lambda x: eda.type_share(x, redeemed_only=True)}
    for name, df in eda.charts(spark.read.parquet(path), lg.columns).items():
        want = single.get(name, getattr(eda, name, None))(lg)
        assert df.columns == want.columns and rows(df) == rows(want), name


# ------------------------------------------------------------------ k-means
def test_random_start_is_the_same_for_any_partitioning(spark):
    pts = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding")
    starts = [kmeans.random_k(pts.repartition(n), 4, "vec_id", 5) for n in (1, 200)]
    assert starts[0] == starts[1] != kmeans.random_k(pts, 4, "vec_id", 6)
    assert all(len(s) == 4 for s in starts)


def test_restarts_keep_the_lowest_error(spark):
    rng = random.Random(2)
    data = [(i, [rng.gauss(c[0], 0.3), rng.gauss(c[1], 0.3)]) for i, c in enumerate([(0, 0), (9, 0), (0, 9), (9, 9)] * 15)]
    pts = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    errors = {}
    for seed in range(1, 6):
        _, got = kmeans.kmeans(pts, 4, "vec_id", start=kmeans.random_k(pts, 4, "vec_id", seed))
        errors[seed] = got.agg(F.sum("sq_error")).first()[0]
    seed, cents, best = kmeans.restarts(pts, 4, "vec_id", list(errors))
    assert best.agg(F.sum("sq_error")).first()[0] == pytest.approx(min(errors.values())) and errors[seed] == min(errors.values())
    assert len(cents) == 4


# ------------------------------------------------------------------ scratch
def test_scratch_goes_and_the_log_stays():
    import subprocess
    import sys
    root = tempfile.mkdtemp(prefix="rf-scratch-")
    code = f"""
import os
from redeemflow.session import build_session, remove_scratch
from redeemflow.plans.queries import QUERIES
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {root!r}}})
assert QUERIES["agg_median"](spark, {SF_SMALL!r}).count() and QUERIES["a_user_sets"](spark, {SF_SMALL!r}).count()
remove_scratch(spark)
print("LEFT", sorted(x.split("-")[0] for x in os.listdir({root!r}) if not x.startswith(".")))
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    got = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": repo})
    assert "LEFT ['coupon_log', 'coupon_log']" in got.stdout, got.stdout + got.stderr[-1500:]
