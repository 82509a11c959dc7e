"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives windows of ``window`` consecutive words; a window
is a set of word shingles.  For full containment a document has to hold every
shingle of a window, so the window's rarest shingle is a necessary prefix: only
that one is joined.  Its position inside the window fixes where the window would
start (positional bound) and end (length bound) in the document, and the words
there are then compared one by one (verification).

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import ascii_lower, cut

#: runs of ASCII characters that are no digit or letter separate words
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: a benchmark side may be broadcast up to so many rows (a window row: about 300 bytes)
MAX_BROADCAST_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased;
    none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAK), "")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Windows of the items: ``win`` (id), ``win_words``, ``size``, ``item_id``, one row per window
    and item.

    An item of fewer than ``window`` words, but not none, is one window.
    """
    w = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where("size(w) > 0")
    n = F.greatest(F.size("w") - window + 1, F.lit(1))
    w = (w.withColumn("at", F.explode(F.sequence(F.lit(1), n)))
         .select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("win_words")))
    return w.distinct().select(F.xxhash64("win_words").alias("win"), "win_words",
                               F.size("win_words").alias("size"), "item_id")


def _shingle(words: Column, at: Column, k) -> Column:
    return F.xxhash64(F.slice(words, at, k if isinstance(k, Column) else F.lit(k)))


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``.  A window of up to ``window`` words is a set of
    ``shingle``-word shingles (its whole sequence if it is shorter).

    ``n_hit`` counts document words inside any occurrence of a window,
    ``n_items`` the items with occurring windows, ``items_sha256`` is the hex
    digest of their ids, sorted as strings and comma-joined.

    Defined cases: null or empty texts have no words and no hits; empty items
    have no window; repeated document rows each get the same result (rows are
    matched by doc_id and text, so equal ids with other texts stay apart);
    repeated items count once per item_id; other columns are ignored.
    """
    n_words = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                          F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    marks = covered_words(docs, items, window, shingle)
    out = (n_words.alias("d").join(
        marks.select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), "n_hit", "ids"),
        F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_key") == F.col("m_key")), "left"))
    ids = F.coalesce("ids", F.expr("cast(array() as array<string>)"))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no window of an item."""
    hit = cut(covered_words(docs, items, window, shingle)
              .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")))
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64("text").alias("_text_key"))
    return rows.join(_bounded(hit), F.col("doc_id").eqNullSafe(F.col("_id"))
                     & (F.col("_text_key") == F.col("_key")), "left_anti").select("_row.*")


def covered_words(docs: DataFrame, items: DataFrame, window: int, shingle: int) -> DataFrame:
    """``doc_id, text_key, n_hit, ids`` of the documents that hold a window."""
    # equal windows of many items are joined once; whose they are is looked up at the end
    owned = cut(item_windows(items, window))
    wins = cut(owned.select("win", "win_words", "size").distinct())
    k = F.least(F.col("size"), F.lit(shingle))
    # every shingle of every window: one per offset
    parts = (wins.select("win", "size", k.alias("k"),
                         F.explode(F.sequence(F.lit(0), F.col("size") - k)).alias("offset"), "win_words")
             .select("win", "size", "k", "offset",
                     _shingle(F.col("win_words"), F.col("offset") + 1, F.col("k")).alias("h")))
    parts = cut(parts)
    # shingle lengths in use: at most `shingle` values
    lens = sorted(r[0] for r in parts.select("k").distinct().collect())
    keys = _bounded(cut(parts.select("k", "h").distinct()))

    base = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       words_of(F.col("text")).alias("w"))
    # shingles of the documents that some window has, with the words around
    # them: enough to compare any window that holds the shingle
    hits = None
    for n in lens:
        pos = (base.select("doc_id", "text_key", "w", F.posexplode("w").alias("pos", "first"))
               .select("doc_id", "text_key", "w", "pos", F.lit(n).alias("k"),
                       _shingle(F.col("w"), F.col("pos") + 1, n).alias("h"))
               .where(F.col("pos") + n <= F.size("w"))
               .join(keys, ["k", "h"])
               .select("doc_id", "text_key", "pos", "k", "h",
                       F.least(F.col("pos"), F.lit(window - n)).alias("before"),
                       F.slice("w", F.greatest(F.col("pos") - (window - n), F.lit(0)) + 1,
                               F.least(F.col("pos"), F.lit(window - n)) + window).alias("around")))
        hits = pos if hits is None else hits.unionByName(pos)
    if hits is None:  # no item has a word
        return docs.where("false").select("doc_id", F.xxhash64("text").alias("text_key"),
                                          F.lit(0).cast("long").alias("n_hit"),
                                          F.expr("cast(array() as array<string>)").alias("ids"))
    hits = cut(hits)
    # rarity over the whole corpus; a shingle that never occurs rules its window out
    count = _bounded(cut(hits.groupBy("k", "h").agg(F.count("*").alias("n"))))
    rare = (parts.join(count, ["k", "h"], "left")
            .groupBy("win", "size", "k")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "offset")).alias("x"))
            .where("x.n > 0").select("win", "k", "x.h", "x.offset"))
    prefix = _bounded(cut(rare.join(wins, "win")))
    found = (hits.join(prefix, ["k", "h"])
             .where("offset <= before")
             .where(F.slice("around", F.col("before") - F.col("offset") + 1, F.col("size"))
                    == F.col("win_words"))
             .select("doc_id", "text_key", (F.col("pos") - F.col("offset")).alias("start"), "size", "win"))
    return _cover(cut(found), owned.select(F.col("win").alias("o_win"), "item_id"))


def _cover(found: DataFrame, owned: DataFrame) -> DataFrame:
    """Words covered by a document's window occurrences, and their items.

    Starts are counted once at their longest size; sorted within the document,
    an occurrence adds what lies beyond the furthest end before it.  A document's distinct
    windows meet their items in a join, so a window of very many items is a list nowhere
    but in the documents that hold it.
    """
    spans = (found.groupBy("doc_id", "text_key", "start").agg(F.max("size").alias("size"))
             .groupBy("doc_id", "text_key")
             .agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans")))
    ids = (found.select("doc_id", "text_key", "win").distinct().join(owned, F.col("win") == F.col("o_win"))
           .groupBy(F.col("doc_id").alias("i_doc"), F.col("text_key").alias("i_key")).agg(F.collect_set("item_id").alias("ids")))
    spans = spans.join(ids, F.col("doc_id").eqNullSafe(F.col("i_doc")) & (F.col("text_key") == F.col("i_key")))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "spans", zero,
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(s["start"], a["end"])))
            .cast("long").alias("n"),
            F.greatest(a["end"], s["start"] + s["size"]).alias("end")),
        lambda a: a["n"])
    return spans.select("doc_id", "text_key", covered.alias("n_hit"), "ids")
