import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from redeemflow.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fp(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(pairs):
    fp = [brute_fp(t) for _, t in pairs]
    group = list(range(len(pairs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(pairs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                group[b] = a
    low = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, f"{fp[i]:016x}", low.get(find(i))) for i, (d, _) in enumerate(pairs)]


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([40, 120, 400]))) for _ in range(12)]
    out = []
    for i, t in enumerate(base):
        out.append((100 + i, t))
        for _ in range(6):
            w = t.split()
            for _ in range(rnd.randrange(3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append((rnd.randrange(10 ** 6), " ".join(w)))
    out += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One two"), (6, "ONE\ttwo"), (7, base[0].upper()),
            (7, base[0].upper()), (None, base[1]), (8, "Á á\xa0b c d")]
    return out


def test_fingerprint_is_exact(spark):
    texts = [t for _, t in corpus(1)] + ["a b c d " * 40_000]
    for t in texts[:-1]:
        assert S.fingerprint(t.encode() if t is not None else None) == brute_fp(t)
    # a text longer than one chunk of words
    assert S.fingerprint(texts[-1].encode()) == brute_fp(texts[-1])
    got = spark.createDataFrame([("w1 w2 w3",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest(b"w1 w2 w3", 42)


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int32)
    parity, _ = S._golay()
    index = S.decode(words)
    codeword = index << 11 | parity[index]
    far = np.bitwise_count((words ^ codeword).astype(np.uint32))
    assert far.max() == 3 and (np.bincount(index) == 2048).all()


def test_every_pair_within_three_bits_is_linked(spark):
    rnd = random.Random(3)
    fps = set()
    for _ in range(150):
        x = rnd.getrandbits(64)
        fps.add(x)
        for _ in range(4):
            y = x
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                y ^= 1 << b
            fps.add(y)
    signed = [x - 2 ** 64 if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {(r.a, r.b) for r in S.links(df).collect()}
    want = {(a, b) for a in signed for b in signed
            if a < b and ((a ^ b) % 2 ** 64).bit_count() <= 3}
    assert got == want and len(want) > 200


def test_groups(spark, make_docs):
    pairs = corpus(5)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.group(make_docs(pairs)).collect()), key=repr)
    assert got == sorted(brute_groups(pairs), key=repr)


def test_one_of_each_group_stays(spark, make_docs):
    pairs = corpus(6)
    kept = [(r.doc_id, r.text) for r in S.deduplicate(make_docs(pairs)).collect()]
    groups = brute_groups(pairs)
    assert sorted(d for d, _ in kept) == sorted({c for _, _, c in groups})
    assert S.deduplicate(make_docs(pairs)).columns == make_docs(pairs).columns
    assert S.deduplicate(make_docs([])).count() == 0 and S.group(make_docs([])).count() == 0
