import random

import public_tokenizers as public
import pytest
import sentencepiece

from redeemflow.llm import token_counts as tc

MODEL = public.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "  ", "\n", "\n\n", " \n", "\n ", "a", " a", "a ", "a b", "a  b", "a\nb", "a \nb", "a\n b", "a\tb",
         "<s>", "</s> <unk> x", "▁", "a▁▁b", "\x00x", "é ｆ 　x\xa0y", "中文字", "<0x0A>",
         "0123456789", "\U0001f600\U0001f600", "a" * 3000, " " * 500, "\r\n\r\n x", "ab " * 5000, "\n" * 300]


@pytest.fixture(scope="module")
def whole():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda t: len(sp.encode(t)) if t else 0


def rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()), key=str)


def test_equals_the_library_on_whole_texts(spark, make_docs, whole):
    pairs = [*enumerate(TEXTS), (3, "a b"), (3, "a b"), (None, "no id")]
    want = sorted(((i, len((t or "").encode()), whole(t), whole(t) > 100) for i, t in pairs), key=str)
    for size in (1, 65_536):  # with next to no table, and with one
        assert rows(tc.token_counts(make_docs(pairs), MODEL, limit=100, frequent=size)) == want


def test_random_texts(whole):
    rng = random.Random(5)
    signs = ["a", "th", "e", " ", " ", "  ", "\n", "\t", "▁", "<s>", "1", ".", "é", "ß", "中", "\x00", "́", "\r"]
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randint(1, 30)))
        assert tc.count_tokens(text, MODEL) == whole(text), repr(text)


def test_given_table(spark, whole):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(((r.doc_id, len((r.text or "").encode()), whole(r.text), whole(r.text) > 4096) for r in docs.collect()), key=str)
    assert rows(tc.token_counts(docs, MODEL)) == want


def test_table_counts_every_text_and_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(tc, "TASK_FREQUENT", 3)
    docs = spark.createDataFrame([("w%d x y" % i,) for i in range(50)], "text string").repartition(5)
    table = tc.frequent_table(docs, MODEL, 4)
    keys = tc._entries(table.keys, table.ends)
    assert len(keys) <= 4 and keys[:2] == ["x", "y"]
    assert list(table.lengths[::2]) == [len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(k)) for k in keys]


def test_memory_of_misses_starts_anew(whole, monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 2)
    sp, _ = tc._encoder(MODEL)
    lengths = tc.Lengths({"the": 1}, sp)
    words = ["aa", "bb", "cc", "dd", "x" * 100, "the"]
    assert [lengths[w] for w in words] == [whole(w) for w in words]
    assert len(lengths.recent) <= 2 and "x" * 100 not in lengths.recent


def test_empty(spark):
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
