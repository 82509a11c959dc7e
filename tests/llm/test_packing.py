import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from redeemflow.llm import packing as P
from redeemflow.llm.queries import tokenizer_files


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_files().tokenizer)
    return t


TEXTS = ["", " ", "  a", "a b", " a  b ", "a\n b\n\nc \n d", "don't  it's 'll", "<|endoftext|> x <|endoftext|>", "é\xa0ß \xa0x",
         "\t\tx \ty", "漢字 かな 😀 x", "x" * 5000 + " y", "a  b 　c", "\x1c \x1d a", "1 22 333 ½ Ⅷ", "end "]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_whole_text(tok, text):
    want = tok.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(P.token_bytes(text, tokenizer_files(), added=True), "<u4").tolist() == want


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x24F) | st.sampled_from(" \n\t's"), max_size=30))
def test_ids_of_any_latin_text(tok, text):
    assert np.frombuffer(P.token_bytes(text, tokenizer_files(), added=True), "<u4").tolist() == tok.encode(
        text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\r\xa0　\x1cab'sé1.,漢́<|>"), max_size=40))
def test_ids_of_odd_spaces(tok, text):
    assert np.frombuffer(P.token_bytes(text, tokenizer_files(), added=True), "<u4").tolist() == tok.encode(
        text, add_special_tokens=False).ids


def test_best_fill_is_best():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randrange(1, 30): rnd.randrange(1, 4) for _ in range(rnd.randrange(0, 6))}
        cap = rnd.randrange(0, 80)
        fill = P.best_fill(counts, cap)
        assert all(m <= counts[x] for x, m in fill.items())
        sums = {0}
        for x, m in counts.items():
            sums = {s + x * k for s in sums for k in range(m + 1)}
        assert sum(x * m for x, m in fill.items()) == max(s for s in sums if s <= cap)


def test_plan_uses_every_piece_once():
    rnd = random.Random(4)
    hist = {min(2047, 1 + int(rnd.expovariate(1 / 500))): rnd.randrange(1, 500) for _ in range(900)}
    plan = P.plan_windows(hist, 2048)
    used = defaultdict(int)
    for fill, times in plan:
        assert sum(x * m for x, m in fill.items()) <= 2048
        for x, m in fill.items():
            used[x] += m * times
    assert used == hist
    total, windows = sum(x * m for x, m in hist.items()), sum(t for _, t in plan)
    assert windows * 2048 <= total * 1.002 + 4096


def test_pack(spark, make_docs, tok, monkeypatch):
    monkeypatch.setattr(P, "RANK_GROUP", 7)
    rnd = random.Random(1)
    pairs = [(i, " ".join(rnd.choice(["the", "of", "andre", "Xyz."]) for _ in range(rnd.choice([3, 3, 40, 900]))))
             for i in range(80)]
    pairs += [(900, None), (901, ""), (902, "word " * 9000), (3, pairs[3][1]), (None, "null id"), (4, "same id")]
    got = [r.asDict() for r in P.pack(make_docs(pairs), tokenizer_files()).collect()]
    check(pairs, got, tok)
    assert P.pack(make_docs([]), tokenizer_files()).count() == 0


def check(pairs, got, tok, window=2048):
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in pairs]
    want = sorted(((d, s, len(x[s:s + window]), zlib.crc32(np.array(x[s:s + window], "<u4").tobytes()), len(x))
                   for d, x in ids for s in range(0, len(x), window)), key=repr)
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got),
                  key=repr) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(seqs)


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "漢字<|endoftext|> x", "<|endoftext|", "x<|endoftext|><|endoftext|>y\n", "plain text"]


def test_added_tokens_keep_their_ids(spark, make_docs):
    from tokenizers import Tokenizer
    unmodified = Tokenizer.from_file(tokenizer_files().tokenizer)
    for text in ADDED:
        want = unmodified.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(P.token_bytes(text, tokenizer_files(), added=True), "<u4").tolist() == want
    assert unmodified.encode(ADDED[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    pairs = list(enumerate(ADDED))
    check(pairs, [r.asDict() for r in P.pack(make_docs(pairs), tokenizer_files()).collect()], unmodified)
