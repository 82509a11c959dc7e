import math
import random
import re

import pytest
from pyspark.sql import functions as F

from redeemflow.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    rep = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(rep)


TEXTS = [None, "", " \t\n", "a", "a b c", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z", "\x1c a\xa0b \x0b\x0c\r c",
         "# * $ % & | < >", "ß é 漢字 😀", "a b c d a b c e b c d", " a \n a \na", "w " * 500 + "end"]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert Q.text_features(text)[:5] == brute(text)


def test_exact_bound():
    for n, k, p in ((10, 0, 0.3), (50, 3, 0.1), (200, 20, 0.15), (5, 5, 0.2)):
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert Q.binomial_cdf(k, n, p) == pytest.approx(want, rel=1e-9)
    assert Q.certified(0, 300, 0.01, 0.05) and not Q.certified(0, 298, 0.01, 0.05)  # 0.99^299 < 0.05
    assert not Q.certified(0, 0, 0.5, 0.5) and not Q.certified(10, 20, 0.4, 0.9)


def docs_and_labels(spark, n, junk):
    clean = "the quick brown fox jumps over a lazy dog number %d and then goes home to sleep for a while " * 4
    rows = []
    for i in range(n):
        text = " ".join(f"{w}{i}x{k}" for k, w in enumerate(("word " * 60).split()))
        if i < junk:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text, "en", 0))
    rows += [(n, None, None, 0), (n + 1, "", "en", 0), (n + 2, clean.replace("%d", "1"), "xx", 0), (0, rows[0][1], "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, stratum int")
    labels = spark.createDataFrame([(i, 0 if i < junk else 1) for i in range(n)] + [(10 ** 6, 1), (None, 1), (3, None)],
                                   "doc_id long, quality int")
    return docs, labels


def test_certified_cutoffs_reject_junk_only(spark):
    docs, labels = docs_and_labels(spark, 2400, 300)
    got = Q.judge(docs, labels).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert not any(by[i][0].kept for i in range(300)) and all(by[i][0].kept for i in range(300, 2400))
    assert by[0][0] == by[0][1] and len(by[0]) == 2
    assert by[2400][0].base_failed and by[2401][0].base_failed and by[2402][0].kept is not None
    assert not by[0][0].base_failed


def test_few_labels_certify_nothing(spark):
    docs, labels = docs_and_labels(spark, 60, 20)
    assert all(r.kept != r.base_failed for r in Q.judge(docs, labels).collect())
    none = Q.judge(docs.limit(0), labels.limit(0))
    assert none.count() == 0
    assert Q.judge(docs, labels.limit(0)).where("not base_failed and not kept").count() == 0


def test_copies_and_contradictions_are_no_evidence(spark):
    docs, labels = docs_and_labels(spark, 40, 0)
    once = Q.choose_cutoffs(Q.features(docs), labels).collect()
    many = docs.crossJoin(spark.range(60)).drop("id")
    renamed = docs.crossJoin(spark.range(60)).withColumn("doc_id", F.col("doc_id") + 1000 * F.col("id")).drop("id")
    their = labels.crossJoin(spark.range(60)).withColumn("doc_id", F.col("doc_id") + 1000 * F.col("id")).drop("id")
    for d, l in ((many, labels), (renamed, their)):
        assert sorted(Q.choose_cutoffs(Q.features(d), l).collect()) == sorted(once)
    assert all(v is None for r in once for v in r[1:])
    docs, labels = docs_and_labels(spark, 200, 0)
    contrary = labels.unionByName(labels.where("doc_id < 150").withColumn("quality", F.lit(0)))
    assert Q.trials(Q.features(docs), labels).count() == 200  # a null label says nothing
    assert Q.trials(Q.features(docs), contrary).count() == 50
    assert all(r.upper_share is None for r in Q.choose_cutoffs(Q.features(docs), contrary).collect())


def test_eighty_six_trials_without_a_rejection_suffice():
    assert Q.certified_step([0] * 10, 86, 0.05, 0.05 / 4) == 9 and Q.certified_step([0] * 10, 85, 0.05, 0.05 / 4) is None
    assert Q.certified_step([0, 0, 80, 0, 0], 500, 0.05, 0.01) == 1  # the walk ends at the first failure


def test_step_of_first_rejection(spark):
    rows = [(0.0,) * 5, (9.0,) + (0.0,) * 4, (0.06, 0.0, 0.0, 0.0, 0.0), (0.0, 0.35, 0.0, 0.06, 0.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{r} double" for r in Q.GRIDS))
    got = [r.s for r in df.select(Q.first_rejected().alias("s")).collect()]
    want = []
    for row in rows:
        hit = [t for t in range(Q.STEPS) if any(v > g[-1 - t] for v, g in zip(row, Q.GRIDS.values()))]
        want.append(min(hit, default=Q.STEPS))
    assert got == want == [10, 0, 9, 6]


def test_guarantee_by_simulation():
    """Over many draws of labels, the true false rejection rate at the certified step exceeds
    the bound no more often than delta allows."""
    rng, risk, delta = random.Random(4), 0.05, 0.1
    true = [0.0, 0.01, 0.03, 0.045, 0.055, 0.08, 0.12, 0.3, 0.5, 0.8]  # rate of rejection at each step
    broken = 0
    for _ in range(600):
        n = 400
        steps = [next((t for t, p in enumerate(true) if u < p), 10) for u in (rng.random() for _ in range(n))]
        step = Q.certified_step([sum(s <= t for s in steps) for t in range(10)], n, risk, delta)
        broken += step is not None and true[step] > risk
    assert broken <= 600 * delta


def test_every_language_of_the_given_tables_certifies_a_path(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.stratum: r for r in Q.choose_cutoffs(Q.features(docs), labels).collect()}
    assert set(got) == {"de", "en", "es", "fr"} and all(None not in r for r in got.values()), got
