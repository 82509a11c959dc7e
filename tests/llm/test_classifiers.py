import random
import zlib

import numpy as np
import pytest

from redeemflow.llm import quality as Q
from redeemflow.llm import toxicity as T
from redeemflow.llm.common import table

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_quality_on_held_out_rows(spark):
    got = Q.classify(table(spark, SF, "documents"), table(spark, SF, "labels")).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    lab = table(spark, SF, "labels").toPandas().merge(got[got.held_out], on="doc_id")
    assert auc(lab.score.values, lab.quality.values) > 0.99
    assert (lab[lab.quality == 1].predicted == 1).mean() > 0.99


def test_quality_scores_do_not_depend_on_other_columns(spark, make_docs):
    pairs = [(i, ("the cat sat on a mat %d " % i) * 9 if i % 2 else "### $$$ !! " * 20) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(7, None), (None, 1), (999, 0), (8, 1)],
                                   "doc_id long, quality int")
    more = [*pairs, (None, None), (500, ""), (1, pairs[1][1]), (501, "x" * 200_000)]
    got = Q.classify(make_docs(more), labels).toPandas()
    assert len(got) == len(more) and got.score.notna().all()
    by_text = Q.score(make_docs([(i + 10 ** 6, t) for i, t in more if i is not None]),
                      Q.fit(make_docs(more), Q._learnable(labels))).toPandas()
    a = got[got.doc_id.notna()].sort_values(["doc_id", "score"]).score.tolist()
    assert a == by_text.sort_values(["doc_id", "score"]).score.tolist()
    assert not got[got.doc_id.isna()].held_out.any()
    kept = Q.accepted(make_docs(more), labels)
    assert kept.columns == make_docs(more).columns
    assert kept.count() == int(got.predicted.sum())


def test_quality_without_labels_or_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.classify(make_docs([(1, "a"), (2, None)]), none).collect()
    assert [r.score for r in got] == [0.5, 0.5]
    assert Q.classify(make_docs([]), none).count() == 0


def test_sample_is_bounded(spark, make_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, y int")
    docs = make_docs([(i % 50, f"text {i}") for i in range(200)])
    w, b = Q.fit(docs, labels, max_rows=10)
    assert np.isfinite(w).all() and np.isfinite(b)


def test_chain_uses_earlier_probabilities():
    rnd = random.Random(3)
    sets, y = [], []
    for _ in range(400):
        insult, rude = rnd.random() < 0.4, rnd.random() < 0.4
        sets.append(np.array(sorted({rnd.randrange(1000, 1400) for _ in range(20)} | ({1, 2} if insult else set())
                                    | ({3, 4} if rude else set()))))
        y.append([insult, rude, insult or rude])
    buckets, models = T.train_chain(sets, np.array(y, int))
    assert [len(m) for m in models] == [len(buckets) + 1 + c for c in range(3)]
    assert (models[2][len(buckets):-1] > 0).all()  # both earlier categories speak for the last
    index = {int(b): i for i, b in enumerate(buckets)}
    p = np.array([T.score_set(np.array(sorted(index[b] for b in s if b in index), int), models) for s in sets])
    assert ((p >= 0.5) == np.array(y)).mean() > 0.98


@pytest.fixture(scope="module")
def toxic(spark):
    return T.chain(table(spark, SF, "documents"), table(spark, SF, "labels"), max_rows=2500).toPandas()


def test_toxicity_on_unseen_rows(spark, toxic):
    labels = table(spark, SF, "labels")
    seen = {r.l_id for r in T._sample(labels.withColumnRenamed("doc_id", "l_id"), 2500).collect()}
    assert len(seen) == 2500
    lab = labels.toPandas().merge(toxic, on="doc_id", suffixes=("_label", ""))
    new = lab[~lab.doc_id.isin(seen)]
    assert len(toxic) == 10_000 and len(new) > 1000
    assert new[new.toxic_label == 1].toxic.mean() > 0.9
    assert new[new.toxic_label == 0].toxic.mean() < 0.02
    assert toxic.filter(like="p_").notna().all().all()
    recall = new[new.toxic_label == 1].groupby("quality").toxic.agg(["mean", "size"])
    print("recall on unseen toxic rows by quality:", recall.to_dict())
    assert recall["mean"][1] > 0.9


def test_toxicity_edge_rows(spark, make_docs):
    docs = make_docs([(i, "you idiot clown" if i % 2 else "good day sir") for i in range(40)]
                     + [(None, None), (100, ""), (1, "you idiot clown"), (101, "word " * 50_000)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(None, 1, 1), (3, 1, None), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = T.chain(docs, labels).collect()
    assert len(got) == 44 and all(r.p_toxic is not None for r in got)
    assert all(r.toxic == (r.doc_id % 2 == 1) for r in got if r.doc_id is not None and r.doc_id < 40)
    none = T.chain(make_docs([(1, "a")]), labels.limit(0)).first()
    assert none.p_toxic == 0.5 and not none.toxic
    assert T.chain(make_docs([]), labels).count() == 0


def test_chain_categories_are_labels_of_every_language(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    cats = T.labelled_categories()
    rows = labels.join(docs.select("doc_id", "lang"), "doc_id").select(
        "lang", *[c.cast("int").alias(n) for n, c in cats.items()]).toPandas()
    assert list(cats)[-1] == "toxic" and len(cats) > 1
    shares = rows.groupby("lang").mean()
    assert len(shares) > 3 and ((shares > 0.01) & (shares < 0.99)).all().all()
    got = T.chain(docs, labels, max_rows=1000)
    assert got.columns == ["doc_id", *(f"p_{c}" for c in cats), "toxic"]


def test_chain_learns_only_known_labels():
    rnd = random.Random(5)
    sets = [np.array(sorted({1, 2, 3} if i % 2 else {4, 5, 6}) + [rnd.randrange(10, 40)]) for i in range(200)]
    y = np.array([[i % 2, i % 2] for i in range(200)])
    y[:100, 0] = -1
    buckets, models = T.train_chain(sets, y)
    index = {int(b): i for i, b in enumerate(buckets)}
    p = np.array([T.score_set(np.array(sorted(index[b] for b in s if b in index), int), models) for s in sets])
    assert ((p >= 0.5) == np.array([[i % 2, i % 2] for i in range(200)])).all()


def test_samples_hold_only_labels_of_the_documents(spark, make_docs):
    docs = make_docs([(i, ("the cat sat on a mat %d " % i) * 9 if i % 2 else "### $$$ you idiot clown " * 20)
                      for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(4000)], "doc_id long, quality int, toxic int")
    w, _ = Q.fit(docs, labels.selectExpr("doc_id", "quality as y"), max_rows=40)
    assert np.abs(w).max() > 0
    score = {r.doc_id: r.score for r in Q.score(docs, (w, _)).collect()}
    assert min(score[i] for i in score if i % 2) > max(score[i] for i in score if not i % 2)
    got = T.chain(docs, labels, max_rows=40).collect()
    assert all(r.toxic == (r.doc_id % 2 == 0) for r in got)
