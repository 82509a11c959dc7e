"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose feature lies above a cutoff.  The cutoffs move
together along one fixed path, from loose to tight.  In every stratum the path is
walked on labelled clean documents as long as the false rejections of all rules
together are provably few: the exact (Clopper-Pearson) binomial upper bound of their
rate is at most ``max_false``.  The first step that fails ends the walk, so its tests
need no correction among themselves; the strata share ``delta`` by Bonferroni's
correction.  With probability 1 - delta every stratum keeps its guarantee.  A stratum
with too few labels certifies no step and rejects nothing by these rules.

A trial is a distinct text: copies of a document add nothing to the evidence.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redeemflow.llm.common import cut

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = b"abcdefghijklmnopqrstuvwxyz"

#: rule -> cutoffs, tight to loose; a document above the cutoff is rejected.  Step 0 of the
#: path is every rule's last cutoff, the last step every rule's first
GRIDS = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0),
    "upper_share": (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
    "marks_per_word": (0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9),
}
#: strata whose chosen cutoffs may be broadcast
MAX_BROADCAST_STRATA = 50_000

_OUT = ("doc_id long, stratum string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, symbols_per_word double, upper_share double, marks_per_word double, "
        "repeat_share double, dup_line_share double")


def text_features(text: str | None) -> tuple:
    """Counts and shares of one whole text (null: empty)."""
    text = text or ""
    # bytes.split() breaks at exactly the six ASCII white space characters
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen, end = Counter(windows), 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeat += i + 3 - max(i, end)
                    end = i + 3
    upper = len(data) - len(data.translate(None, _UPPER))
    letters = upper + len(data) - len(data.translate(None, _LOWER))
    marks = text.count("!") + text.count("?")
    return (n, chars, symbols, dup_lines, repeat, symbols / max(n, 1), upper / max(letters, 1),
            marks / max(n, 1), repeat / max(n, 1), dup_lines / max(len(lines), 1))


def _feature_batches(batches):
    names = [f.split(" ")[0] for f in _OUT.split(", ")]
    for b in batches:
        got = [text_features(t.as_py()) for t in b.column("text")]
        cols = list(zip(*got)) if got else [[]] * 10
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").cast(pa.int64()), b.column("stratum").cast(pa.string()), b.column("text_key")]
            + [pa.array(c, pa.int64()) for c in cols[:5]]
            + [pa.array(c, pa.float64()) for c in cols[5:]], names)


def features(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(stratum), F.lit("")).alias("stratum"),
                        F.xxhash64("text").alias("text_key"), "text")
            .mapInArrow(_feature_batches, _OUT))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in logs from the largest term."""
    if k >= n:
        return 1.0
    low = max(0, k - int(20 * math.sqrt(n * p)) - 2000)  # terms below add nothing
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
           + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(low, k + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in log))


def certified(k: int, n: int, risk: float, level: float) -> bool:
    """Is the exact upper confidence bound of the rate k/n at most ``risk``?

    The Clopper-Pearson bound is <= risk just when k or fewer events have
    probability <= level at the rate ``risk``.
    """
    return n > 0 and k / n < risk and binomial_cdf(k, n, risk) <= level


STEPS = min(map(len, GRIDS.values()))


def first_rejected() -> F.Column:
    """The first step of the path at which some rule rejects a document; STEPS if none."""
    steps = []
    for rule, grid in GRIDS.items():
        # cutoffs that the feature is above: those from the loosest one on count back
        steps.append(F.lit(STEPS) - sum((F.col(rule) > c).cast("int") for c in grid))
    return F.least(*steps)


def trials(feats: DataFrame, labels: DataFrame) -> DataFrame:
    """``stratum, step``: one row per distinct clean text.  A text is clean if it has labels
    and all of them, over all documents that hold it, say so."""
    known = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("l_id"))
             .agg(F.min("quality").alias("worst")))
    held = feats.select("*", first_rejected().alias("step")).join(known, F.col("doc_id") == F.col("l_id"))
    return (held.groupBy("stratum", "text_key").agg(F.min("worst").alias("worst"), F.min("step").alias("step"))
            .where("worst = 1").select("stratum", "step"))


def certified_step(rejected: list[int], n: int, risk: float, level: float) -> int | None:
    """The last step of the walk that is certified; ``rejected`` are the false rejections
    at every step, of ``n`` trials."""
    last = None
    for step, k in enumerate(rejected):
        if not certified(k, n, risk, level):
            break
        last = step
    return last


def choose_cutoffs(feats: DataFrame, labels: DataFrame, max_false: float = 0.05,
                   delta: float = 0.05) -> DataFrame:
    """``stratum`` and one column per rule: the cutoffs of the last certified step, null if
    there is none."""
    counts = trials(feats, labels).groupBy("stratum").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum((F.col("step") <= t).cast("long")) for t in range(STEPS)]).alias("rejected"))
    counts = cut(counts)
    level = delta / max(1, counts.count())
    schema = "stratum string, " + ", ".join(f"{r} double" for r in GRIDS)

    def pick(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                step = certified_step(r["rejected"], r["n"], max_false, level)
                rows.append([r["stratum"]] + [None if step is None else grid[-1 - step] for grid in GRIDS.values()])
            cols = list(zip(*rows)) if rows else [[]] * (1 + len(GRIDS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string())] + [pa.array(c, pa.float64()) for c in cols[1:]],
                ["stratum", *GRIDS])

    return counts.mapInArrow(pick, schema)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", max_false: float = 0.05,
          delta: float = 0.05) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    Defined cases: a null or empty text has no words and fails the base rules;
    a null stratum is the empty one; labels of unknown documents and null
    qualities are ignored, and a text whose labels contradict each other is no
    trial; repeated rows are judged alike, and copies are one trial; without labels
    no learned rule rejects.  Other columns are ignored.
    """
    feats = cut(features(docs, stratum))
    cutoffs = cut(choose_cutoffs(feats, labels, max_false, delta))
    if cutoffs.count() <= MAX_BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    cutoffs = cutoffs.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in GRIDS])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rejected = F.lit(False)
    for rule in GRIDS:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"cut_{rule}"), F.lit(False))
    return (feats.join(cutoffs, "stratum", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & ~rejected).alias("kept"), "stratum", *GRIDS))
