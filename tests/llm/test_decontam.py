import hashlib
import random
import re

from redeemflow.llm import decontam
from redeemflow.llm.decontam import contamination, uncontaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(low)


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                found = wins.get(tuple(w[i:i + n]))
                if found:
                    ids |= found
                    hit |= set(range(i, i + n))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=repr)


def fixture(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "Ä", "e1", "thor", "x", "ÉA", "z"]
    text = lambda n: rnd.choice([" ", ", ", "--"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 4, 7, 9, 10, 11, 25]))) for i in range(14)]
    items += [(3, items[3][1]), (40, None), (41, ""), (42, "!!"), (43, items[5][1])]
    docs = []
    for i in range(30):
        parts = [text(rnd.randrange(12)) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, rnd.choice(items[:14])[1].upper())
        docs.append((i, "\n".join(parts)))
    docs += [(30, None), (31, ""), (32, "..."), (5, docs[5][1]), (6, "the of other text"), (None, items[9][1])]
    docs.append((33, " ".join([items[8][1]] * 300)))
    return docs, items


def test_matches_brute_force(spark, make_docs):
    for seed in range(2):
        docs, items = fixture(seed)
        b = spark.createDataFrame(items, "item_id long, text string")
        got = [tuple(r) for r in contamination(make_docs(docs), b).collect()]
        want = brute(docs, items)
        assert sorted(got, key=repr) == want
        kept = uncontaminated(make_docs(docs), b).collect()
        assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted(
            ((d, t) for d, t in docs if not brute([(d, t)], items)[0][5]), key=repr)


def test_joins_without_broadcast(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_BROADCAST_ROWS", -1)
    docs, items = fixture(7)
    got = contamination(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = [(1, "a b"), (2, None)]
    got = contamination(make_docs(docs), none).collect()
    assert sorted(map(tuple, got)) == brute(docs, [])
    assert uncontaminated(make_docs(docs), none).count() == 2
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert contamination(make_docs([]), one).count() == 0


def test_no_python_in_the_plan(spark, make_docs):
    plan = contamination(make_docs([(1, "a b")]), spark.createDataFrame([(1, "a")], "item_id long, text string"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
