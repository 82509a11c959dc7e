r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes one example: all preceding turns are its context
and only that reply is trainable.  A conversation that does not end in an
assistant turn gives one last example without a trainable part, so no turn is
left out of the output.

Template (fixed values)::

    [INST]role\ntext[/INST]      any turn but the assistant's
    <s>text</s>                  an assistant turn

A control string inside a role or text gets one backslash after its first
character (``</s>`` -> ``<\/s>``, ``<\/s>`` -> ``<\\/s>``), which is undone by taking
one away.  Line feeds and backslashes of a role are written ``\n`` and ``\\``.

An example is a prefix of its conversation's formatted text, written out in full: the
output grows with the square of a conversation's turns, as the method does (README has
figures).  The read-back takes replies and their marks from these texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: turns whose offsets are summed together before conversations are
TURNS_PER_BLOCK = 64

_CONTROL = r"(?=/?s>|/?INST\])"
_SEGMENT = re.compile(r"\[INST\](.*?)\n(.*)\[/INST\]|<s>(.*)</s>", re.S)
#: segments of an example: their marks occur nowhere else
_SEGMENTS = re.compile(r"\[INST\].*?\[/INST\]|<s>.*?</s>", re.S)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def segment(role: Column, text: Column) -> Column:
    line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return (F.when(role == "assistant", F.concat(F.lit("<s>"), escape(text), F.lit("</s>")))
            .otherwise(F.concat(F.lit("[INST]"), escape(line), F.lit("\n"), escape(text),
                                F.lit("[/INST]"))))


def read_segment(seg: str) -> tuple[str, str]:
    """Role and text of one segment."""
    role, text, reply = _SEGMENT.fullmatch(seg).groups()
    if reply is not None:
        return "assistant", unescape(reply)
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)
    return role, unescape(text)


def read_example(text: str):
    """Role and text of the segments of an example, in order."""
    at = 0
    for m in _SEGMENTS.finditer(text):
        if m.start() != at:
            break
        at = m.end()
        yield read_segment(m[0])
    if at != len(text):
        raise ValueError(f"no segment at {at}: {text[at:at + 40]!r}")


def expand(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, turn, seq, segment, start, end, target, loss_start, loss_end,
    last, text``.

    ``start`` and ``end`` are code point offsets in the conversation's formatted
    text.  A row with ``target`` is an example: ``text`` is the context ``[0, start)`` and the
    reply, of which ``[loss_start, loss_end)`` is trainable.  A ``last`` row without
    ``target`` is the example without a trainable part.  Other rows have no ``text``.

    Defined cases: null role or text is empty; turns are ordered by turn
    (nulls first), then role, then text; repeated rows are turns of their own;
    rows with a null conv_id form one conversation; other columns are ignored.

    Offsets are summed in two steps, within blocks of turns and then over
    blocks, so a conversation with very many turns is spread over tasks (rows of one
    turn number, and those without one, are of one block: sorted in one task).  The
    examples of a conversation are written by one task, one at a time.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    shown = segment(F.col("role"), F.col("text"))
    rows = rows.select("*", F.length(shown).cast("long").alias("n"),
                       F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block"))  # null turns: the null block, first
    inner = (Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("b_end", F.sum("n").over(inner)).withColumn("b_seq", F.count("*").over(inner))
    blocks = rows.groupBy("conv_id", "block").agg(F.max("b_end").alias("size"), F.max("b_seq").alias("turns"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("seq0"),
        F.coalesce(F.sum("turns").over(after), F.lit(0)).alias("later"), "turns")
    out = rows.join(blocks, F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block")))
    end = F.col("base") + F.col("b_end")
    target = F.col("role") == "assistant"
    out = out.select(
        "conv_id", "turn", (F.col("seq0") + F.col("b_seq") - 1).alias("seq"), shown.alias("segment"),
        (end - F.col("n")).alias("start"), end.alias("end"), target.alias("target"),
        F.when(target, end - F.col("n") + 3).alias("loss_start"),
        F.when(target, end - 4).alias("loss_end"),
        ((F.col("later") == 0) & (F.col("b_seq") == F.col("turns"))).alias("last"))
    so_far = Window.partitionBy("conv_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefix = F.collect_list("segment").over(so_far)
    return (out.withColumn("_prefix", prefix)
            .select(*out.columns, F.when(F.col("target") | F.col("last"), F.array_join("_prefix", "")).alias("text")))


def render(segments: DataFrame) -> DataFrame:
    """The examples alone: ``conv_id, seq, text, loss_start, loss_end``."""
    return segments.where("target or last").select("conv_id", "seq", "text", "loss_start", "loss_end")


READ_BACK = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_examples long")


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, read from the examples' texts in the output of ``expand``.

    Replies are cut out of their own examples by the loss range, turns are read
    from the last example, which holds them all; ``formatted_chars`` adds up the lengths of
    the conversation's examples.  A digest runs over its conversation in order, so a
    conversation stays in one task; that task streams its sorted rows and holds one batch.
    """
    reply = F.when(F.col("target"), F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = segments.where("target or last").select(
        "conv_id", "seq", F.when(F.col("last"), F.col("text")).alias("whole"), reply.alias("reply"),
        F.length("text").cast("long").alias("chars"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(_digests, READ_BACK)


def _digests(batches):
    fields = [f.split(" ")[0] for f in READ_BACK.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    state = None
    for batch in batches:
        done = []
        for r in batch.to_pylist():
            if state is None or state[0] != r["conv_id"]:
                if state is not None:
                    done.append(_finish(state))
                state = [r["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            if r["whole"] is not None:
                for role, text in read_example(r["whole"]):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
            if r["reply"] is not None:
                reply = unescape(r["reply"])
                state[3] += len(reply)
                state[4].update(reply.encode())
            state[5] += r["chars"]
            state[6] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), types)]
                                         if done else [pa.array([], t) for t in types], fields)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(_finish(state), types)], fields)


def _finish(s):
    return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6]
