import hashlib
import random

import numpy as np

from redeemflow.llm import suffix as S


def brute(pairs, width=50):
    key = lambda d: (1 << 63) - 1 if d is None else d
    low = {}
    data = [(d, (t or "").encode()) for d, t in pairs]
    for d, x in data:
        for s in range(len(x) - width + 1):
            low[x[s:s + width]] = min(key(d), low.get(x[s:s + width], key(d)))
    out = []
    for d, x in data:
        gone = bytearray(len(x))
        for s in range(len(x) - width + 1):
            if low[x[s:s + width]] < key(d):
                gone[s:s + width] = b"\1" * width
        kept = bytes(b for b, f in zip(x, gone) if not f)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        out.append(((d, len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()), kept))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["the", "of", "andre", "tion", "é", "x\x00y", "漢字", "w", "\xff", "long" * 5]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passages = [text(30), text(12), text(14), "ab" * 60, "a" * 130]
    out = []
    for i in range(60):
        parts = [text(rnd.randrange(25)) for _ in range(3)]
        if i % 2:
            p = rnd.choice(passages)
            cut = rnd.randrange(10)
            parts.insert(rnd.randrange(3), p[cut:])
        out.append((rnd.choice([i, 1000 - i]), "\n".join(parts)))
    out += [(500, out[3][1]), (501, out[3][1]), (500, out[3][1]), (500, "other " + passages[0]), (None, out[5][1]),
            (502, None), (503, ""), (504, "short"), (505, passages[0][:50]), (506, passages[0] * 40)]
    return out


def test_suffix_arrays_and_prefixes():
    rnd = random.Random(1)
    for _ in range(150):
        x = bytes(rnd.choice(rnd.choice([b"ab", b"abc\xff", b"a", b"\x00\x01"])) for _ in range(rnd.randrange(50)))
        a = np.frombuffer(x, np.uint8)
        sa, _ = S.suffix_array(a)
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        lcp = S.common_prefixes(a, sa).tolist()
        for r in range(1, len(x)):
            p, q = x[sa[r - 1]:], x[sa[r]:]
            k = next((i for i, (u, v) in enumerate(zip(p, q)) if u != v), min(len(p), len(q)))
            assert lcp[r] == k


def test_every_window_has_its_anchor(monkeypatch):
    rnd = random.Random(2)
    x = b"".join(rnd.choice([b"the ", b"of ", b"andre ", b"aaaaaaaa"]) for _ in range(900))
    ends = np.array([700, 730, 730, len(x)])
    buf = np.frombuffer(x + bytes(8), np.uint8)
    at, h = S.anchors(buf, ends, 50)
    for s in range(len(x) - 49):
        if not any(s < e < s + 50 for e in ends):
            assert ((at >= s) & (at <= s + 50 - S.GRAM)).any()
    monkeypatch.setattr(S, "SLAB", 333)  # slabs change nothing
    at2, h2 = S.anchors(buf, ends, 50)
    assert at.tolist() == at2.tolist() and h.tolist() == h2.tolist()


def test_report(spark, make_docs):
    for seed in range(3):
        pairs = corpus(seed)
        got = sorted((tuple(r) for r in S.report(make_docs(pairs)).collect()), key=repr)
        assert got == sorted((r for r, _ in brute(pairs)), key=repr)


def test_runs_of_nul_bytes(spark, make_docs):
    x = b"\0" * 60 + b"some text between the runs" + b"\0" * 25 + b"of bytes " + b"\0" * 70
    at, h = S.anchors(np.frombuffer(x + bytes(8), np.uint8), np.array([len(x)]), 50)
    assert (h > 0).all()
    for s in range(len(x) - 49):
        assert ((at >= s) & (at <= s + 50 - S.GRAM)).any()
    passage = "\0" * 200
    pairs = [(1, "first one " + passage + " goes on"), (2, "and another " + passage + " ends"), (3, passage),
             (4, "x" * 20 + "\0" * 24 + "y" * 20), (5, "ab" + "x" * 20 + "\0" * 24 + "y" * 20)]
    got = sorted((tuple(r) for r in S.report(make_docs(pairs)).collect()), key=repr)
    assert got == sorted((r for r, _ in brute(pairs)), key=repr)
    assert [r[2] for r in got] == [0, 202, 200, 0, 64]


def test_whole_contexts_keep_64_bits():
    x = np.frombuffer(b"".join(b"%020d" % i for i in range(400)) + bytes(8), np.uint8)
    at = np.arange(100, 7000)
    full = np.full(len(at), 30), np.full(len(at), 50)
    for left, right in (full, (full[0] - 3, full[1])):
        assert int(S._context_hash(x, at, left, right, 50).max()) >> 60


def test_heavy_grams_are_split_and_merged(spark, make_docs, monkeypatch):
    monkeypatch.setattr(S, "SHARD_CONTEXTS", 2)
    monkeypatch.setattr(S, "MAX_BROADCAST", -1)
    pairs = corpus(9) + [(2000 + i, f"{i} tail of passage that is common to all of the texts {i}") for i in range(40)]
    pairs += [(3000 + i, f"{i % 5}9 tail of passage that is common to all of the texts {i % 7}x") for i in range(40)]
    got = sorted((tuple(r) for r in S.report(make_docs(pairs)).collect()), key=repr)
    assert got == sorted((r for r, _ in brute(pairs)), key=repr)


def test_cleaned(spark, make_docs):
    pairs = corpus(4)
    got = S.cleaned(make_docs(pairs))
    assert got.columns == make_docs(pairs).columns
    want = [(r[0], None if t is None else kept.decode("utf-8", "ignore"))
            for (r, kept), (_, t) in zip(brute(pairs), pairs) if kept.decode("utf-8", "ignore") or not t]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert S.report(make_docs([])).count() == 0 and S.cleaned(make_docs([])).count() == 0


def test_ranges():
    def parts(n, ranges):
        a = np.array(ranges, np.int64).reshape(-1, 2)
        return S.kept_parts(n, a[:, 0], a[:, 1])
    assert parts(10, []) == ([(0, 10)], 0, 0)
    assert parts(10, [(-5, 3), (3, 4), (8, 20), (2, 3)]) == ([(4, 8)], 6, 2)
    assert parts(10, [(5, 5), (2, 9), (3, 4)]) == ([(0, 2), (9, 10)], 7, 1)
    assert parts(0, [(0, 5)]) == ([], 0, 0)


def test_long_runs_are_a_few_contexts(spark, make_docs):
    """Runs of one byte and of short periods: one context per kind and document, the result
    of the brute-force version, also where only a part of a run occurs before."""
    pairs = [(1, "b" * 300 + "a" * 3000), (2, "x" + "a" * 5000 + "tail" * 5), (3, "abc" * 1200), (4, "zabc" + "abc" * 1500 + "q"),
             (5, "c" * 49), (6, "c" * 60), (7, "c" * 200 + "d" + "c" * 200), (8, "0123456789abcdef" * 300),
             (9, "q" + "0123456789abcdef" * 310 + "r" + "0123456789abcdef" * 20), (10, "a" * 70 + "b" * 90),
             (11, ("word " * 30 + "\n") * 40), (12, ("word " * 31 + "\n") * 20), (4, "a" * 400)]
    got = sorted((tuple(r) for r in S.report(make_docs(pairs)).collect()), key=repr)
    assert got == sorted((r for r, _ in brute(pairs)), key=repr)
    cols = [S.pa.array([t.encode() for _, t in pairs], S.pa.binary()), S.pa.array([i for i, _ in pairs]),
            S.pa.array(range(len(pairs)))]
    batch = S.pa.RecordBatch.from_arrays(cols, ["data", "id", "sub"])
    rows = [r for out in S._anchor_batches([batch], 50) for r in out.to_pylist()]
    per_doc = [sum(r["pack"] >> S._POS_BITS == k for r in rows) for k in range(len(pairs))]
    assert max(per_doc) < 700, per_doc  # 5000 bytes of one letter would be 5000


def test_megabytes_of_one_byte(spark, make_docs):
    n = 2_000_000
    got = {r.doc_id: r for r in S.report(make_docs([(1, "a" * n), (2, "a" * (n + 7)), (3, "xyz" * (n // 3)), (4, "yzx" * (n // 3))])).collect()}
    assert [(got[k].n_removed, got[k].n_spans) for k in (1, 2, 3, 4)] == [(0, 0), (n + 7, 1), (0, 0), (n // 3 * 3, 1)]
