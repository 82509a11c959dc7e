import re

from redeemflow.llm import quality as Q
from redeemflow.llm.common import table
from redeemflow.llm.queries import QUERIES, tokenizer_files
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_groups
from tests.llm.test_suffix import brute as brute_cuts

import corpus_pipeline as C

SF = "/root/testdata/sf0.001"


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_match_plain_versions(spark):
    docs = table(spark, SF, "documents")
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    names = [n for n, _ in C.STAGES]
    rows, now = docs, pairs(docs)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out = C.store(out, "test-stage")
        got = pairs(out)
        if name == "quality classifier":
            weights, bias = Q.fit(rows, Q._learnable(table(spark, SF, "labels")))
            want = [(d, t) for d, t in now if Q.score_text(t.encode(), weights, bias, {}) >= 0.3]
            assert 0 < len(want) < len(now)
        elif name == "SimHash near-dedup":
            low = {d: c for d, _, c in brute_groups(now)}
            want = [(d, t) for d, t in now if low[d] == d]
        elif name == "suffix-array dedup":
            left = [(r[0], kept.decode("utf-8", "ignore")) for r, kept in brute_cuts(now)]
            want = [(d, t) for d, t in left if t]
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            hit = {r[0] for r in brute_hits(now, items) if r[5]}
            want = [(d, t) for d, t in now if d not in hit]
        assert got == sorted(want), name
        rows, now = out, got
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_files().tokenizer)
    last = C.STAGES[-1][1](spark, rows, SF)
    check(now, [r.asDict() for r in last.collect()], tok)
    assert sorted(map(tuple, C.run(spark, SF).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, last.select("doc_id", "start", "length", "ids_crc32").collect()))
    assert len(names) == len(set(names)) == 5


def test_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(names) == set(QUERIES) and "pipeline" in E.queries()
