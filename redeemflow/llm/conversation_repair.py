"""Conversation structure repair by weighted interval parsing.

A conversation is well formed if its roles read ``(s?(ua)+)?``: an optional system
turn, then user and assistant in turn.  The repair grammar is in Chomsky normal
form.  Its nonterminals are pairs of places in that pattern,

    [p r] -> [p q] [q r]        two neighbouring spans
    [p q] -> row                an edit of one row: keep, rerole, delete
    [p q] -> (nothing)          inserted turns

A cell holds, per nonterminal, the smallest (cost, audit) of its span.  The audit
is the edits' initials in order.  It fixes the cost, so of two equal costs neither
audit is a prefix of the other and the smaller one stays smaller whatever
surrounds it: smallest cells of parts give the smallest cell of the whole.  Cells
are closed under insertion, and spans are combined bottom-up by length.  As the
pattern is regular, any split of a span gives the same cell (whatever the parts
derive, some place lies between them), so one split a span is enough: 2n spans,
not n^2 / 2, and a long conversation can be cut anywhere.

On Spark, rows are dealt by range of (conversation, turn, role, text), so a very long
conversation is spread over tasks.  Each task hands on one cell per conversation,
with what the counts need at its ends; a second pass combines those cells and
reads the conversation through once, in order, with the audit beside it.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import cut

# Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# The pattern.  Places: 0 start, 1 after a system turn, 2 after a user
# turn, 3 after an assistant turn.
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
PLACES, ACCEPTED = range(4), (0, 3)
LEGAL = {"su", "ua", "au"}

PAIRS = [(p, q) for p in PLACES for q in PLACES]
#: rows whose span is looked up as one: most conversations are that short
BLOCK = 16
WHITE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------------ cells
def join(left: dict, right: dict) -> dict:
    """Cell of two neighbouring spans."""
    out: dict = {}
    for (p, q), (c1, a1) in left.items():
        for r in PLACES:
            other = right.get((q, r))
            if other is None:
                continue
            cost, have = c1 + other[0], out.get((p, r))
            if have is None or cost < have[0] or (cost == have[0] and a1 + other[1] < have[1]):
                out[p, r] = (cost, a1 + other[1])
    return out


def _closure() -> dict:
    """Cell of the empty span: any number of inserted turns."""
    stay = {(p, p): (0, "") for p in PLACES}
    one = stay | {(p, q): (INSERT, "I") for role in "ua" for p, q in MOVES[role].items()}
    cell = stay
    while (longer := join(cell, one)) != cell:
        cell = longer
    return cell


CLOSURE = _closure()


def _least(options) -> dict:
    out: dict = {}
    for pair, cost, audit in options:
        out[pair] = min(out.get(pair, (cost, audit)), (cost, audit))
    return out


@lru_cache(None)
def leaf(kind: str) -> dict:
    """Cell of one row.  ``kind`` is the initial of its role (``o``: another), in upper
    case if the row is truncated, or ``x`` if it has to go."""
    options = [((p, p), DELETE, "D") for p in PLACES]
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        options += [(move, more, "K") for move in MOVES.get(kind.lower(), {}).items()]
        options += [(move, REROLE + more, "R") for role in "ua" for move in MOVES[role].items()]
    return join(join(CLOSURE, _least(options)), CLOSURE)


def deleted(n: int) -> dict:
    """Cell of ``n`` rows that all have to go."""
    return {pair: (cost + DELETE * n, "D" * n + audit) for pair, (cost, audit) in CLOSURE.items()}


def parse(cells: list[dict]) -> dict:
    """Cell of a sequence of spans, combined bottom-up by span length."""
    while len(cells) > 1:
        cells = [join(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else CLOSURE


@lru_cache(100_000)
def block(kinds: str) -> dict:
    return parse([leaf(k) for k in kinds])


class Spans:
    """Cells of the spans seen so far; neighbours of like length are combined, so
    ``n`` spans leave about ``log n``."""

    def __init__(self):
        self.kinds, self.stack = "", []

    def add(self, kind: str, also_deleted: int):
        self.kinds += kind
        if also_deleted > BLOCK:
            self._flush()
            self.push(deleted(also_deleted), also_deleted)
        else:
            self.kinds += "x" * also_deleted
        if len(self.kinds) >= BLOCK:
            self._flush()

    def _flush(self):
        if self.kinds:
            self.push(block(self.kinds), len(self.kinds))
            self.kinds = ""

    def push(self, cell: dict, n: int):
        while self.stack and self.stack[-1][1] <= n:
            before, m = self.stack.pop()
            cell, n = join(before, cell), n + m
        self.stack.append((cell, n))

    def cell(self) -> dict:
        self._flush()
        if not self.stack:
            return CLOSURE
        cell = self.stack[-1][0]
        for before, _ in reversed(self.stack[:-1]):
            cell = join(before, cell)
        return cell


def cheapest(cell: dict) -> tuple[int, str]:
    return min(cell[0, q] for q in ACCEPTED)


# ----------------------------------------------------------------------- counts
class Counts:
    """Counts of a run of rows, with what joining it to the next run needs."""

    def __init__(self, faults=(0, 0, 0, 0), turns=None, first=None, last=None):
        self.blank, self.duplicate, self.truncated, self.illegal = faults
        self.turns, self.first, self.last = turns, first, last  # turns: lowest, highest, how many

    def add(self, other: Counts) -> Counts:
        """This run and the one after it."""
        if other.first is None:
            return self
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal + (self.first is not None and self.last + other.first not in LEGAL)
        if other.turns:
            lo, hi, n = other.turns
            self.turns = (self.turns[0], hi, self.turns[2] + n - (self.turns[1] == lo)) if self.turns else other.turns
        self.first, self.last = other.first if self.first is None else self.first, other.last
        return self

    @classmethod
    def of_row(cls, turn, initial, blank, first, truncated, n) -> Counts:
        faults = (n if blank else 0, 0 if blank else n - first, int(truncated), (n - 1) * (2 * initial not in LEGAL))
        return cls(faults, None if turn is None else (turn, turn, 1), initial, initial)

    @property
    def gaps(self) -> int:
        return self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0


# ------------------------------------------------------------------------ Spark
_KEY = ["no_conv", "conv"]
_PART = "costs array<long>, audits array<string>, faults array<long>, turns array<long>, first string, last string"
_SPAN = "no_conv boolean, conv long, part long, " + _PART


def _marked(conversations: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text), with how often it is there
    and what is wrong with it.

    Copies are counted before they move.  Whether an equal role and text came at an
    earlier turn is found by an aggregate and a join, which Spark can split where one
    text fills much of a conversation.
    """
    rows = conversations.select(
        F.col("conv_id").isNull().alias("no_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.groupBy(*_KEY, "turn", "role", "text").agg(F.count("*").alias("n"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    early = rows.groupBy(*_KEY, "role", "text").agg(F.min(when).alias("early"))
    core = F.rtrim(F.col("text"), F.lit(WHITE))
    first = when == F.col("early")
    return (rows.join(early, [*_KEY, "role", "text"])
            .select(*_KEY, "turn", "role", "text", "n", F.substring("role", 1, 1).alias("initial"),
                    (core == "").alias("blank"), (first & (core != "")).alias("first"),
                    (first & (core != "") & ~F.substring(core, -1, 1).isin(".", "!", "?")).alias("truncated")))


def _kind(r) -> str:
    if not r["first"]:
        return "x"
    kind = r["initial"] if r["initial"] in MOVES else "o"
    return kind.upper() if r["truncated"] else kind


def _spans(batches):
    """One row per conversation of a sorted partition."""
    part, state = TaskContext.get().partitionId(), None

    def done():
        (no_conv, conv), spans, counts = state
        cell = spans.cell()
        found = [cell.get(p, (None, None)) for p in PAIRS]
        return {"no_conv": no_conv, "conv": conv, "part": part, "costs": [c for c, _ in found],
                "audits": [a for _, a in found], "first": counts.first, "last": counts.last,
                "faults": [counts.blank, counts.duplicate, counts.truncated, counts.illegal],
                "turns": list(counts.turns) if counts.turns else None}
    for b in batches:
        out = []
        for r in b.to_pylist():
            key = (r["no_conv"], r["conv"])
            if state is None or state[0] != key:
                if state:
                    out.append(done())
                state = (key, Spans(), Counts())
            state[1].add(_kind(r), r["n"] - 1)
            state[2].add(Counts.of_row(*(r[c] for c in ("turn", "initial", "blank", "first", "truncated", "n"))))
        if out:
            yield pa.RecordBatch.from_pylist(out, _SPAN_ARROW)
    if state:
        yield pa.RecordBatch.from_pylist([done()], _SPAN_ARROW)


_LONGS, _TEXTS = pa.list_(pa.int64()), pa.list_(pa.string())
_SPAN_ARROW = pa.schema([("no_conv", pa.bool_()), ("conv", pa.int64()), ("part", pa.int64()), ("costs", _LONGS),
                         ("audits", _TEXTS), ("faults", _LONGS), ("turns", _LONGS), ("first", pa.string()),
                         ("last", pa.string())])
_REPORT = pa.schema([(n, pa.int64()) for n in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                    + [("audit", pa.string()), ("repaired_sha256", pa.string())])
_TURNS = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                    ("role", pa.string()), ("text", pa.string())])


class _Conversation:
    """One conversation of the second pass: its cells first, then its rows in order."""

    def __init__(self, key):
        self.key, self.spans, self.counts = key, Spans(), Counts()
        self.audit, self.at, self.place, self.seq = None, 0, 0, 0

    def part(self, r):
        cell = {p: (c, a) for p, c, a in zip(PAIRS, r["costs"], r["audits"]) if c is not None}
        self.spans.push(cell, sum(a != "I" for a in cell[0, 0][1]))
        self.counts.add(Counts(r["faults"], tuple(r["turns"]) if r["turns"] else None, r["first"], r["last"]))

    def begin(self):
        self.cost, self.audit = cheapest(self.spans.cell())

    def take(self, row=None):
        """Turns up to the next row's, or the inserted ones at the end."""
        while self.at < len(self.audit):
            edit = self.audit[self.at]
            if edit != "I" and row is None:
                raise ValueError("more edits than rows")
            self.at += 1
            if edit != "D":
                role = row["role"] if edit == "K" else "assistant" if self.place == 2 else "user"
                self.place = MOVES[role[0]][self.place]
                text, turn = ("", None) if edit == "I" else (row["text"], row["turn"])
                yield self.seq, edit, turn, role, text
                self.seq += 1
            if edit != "I":
                return


def _conversations(batches, turns: bool):
    """Reports, or repaired turns, of a partition sorted by conversation, its cells first."""
    schema = _TURNS if turns else _REPORT
    state, digest, out, size = None, None, [], 0

    def put(found):
        nonlocal size
        for seq, edit, turn, role, text in found:
            if turns:
                out.append(dict(zip(_TURNS.names, (conv_id(), seq, edit, turn, role, text))))
                size += len(text)
            else:
                digest.update(("\n" if seq else "").encode() + f"{role}:{text}".encode())

    def conv_id():
        return None if state.key[0] else state.key[1]

    def done():
        if state.audit is None:
            state.begin()
        put(state.take())
        if not turns:
            c = state.counts
            out.append(dict(zip(_REPORT.names, (conv_id(), c.gaps, c.blank, c.duplicate, c.truncated, c.illegal,
                                                state.cost, state.audit, digest.hexdigest()))))
    for b in batches:
        for r in b.to_pylist():
            key = (r["no_conv"], r["conv"])
            if state is None or state.key != key:
                if state:
                    done()
                state, digest = _Conversation(key), hashlib.sha256()
            if r["tag"] == 1:
                state.part(r)
            elif r["tag"] == 2:
                if state.audit is None:
                    state.begin()
                for _ in range(r["n"]):
                    put(state.take(r))
            if size > 1 << 24:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
            out, size = [], 0
    if state:
        done()
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _second_pass(conversations: DataFrame, ids: DataFrame | None, turns: bool, schema: str) -> DataFrame:
    rows = cut(_marked(conversations))
    dealt = (rows.repartitionByRange(*_KEY, "turn", "role", "text")
             .sortWithinPartitions(*_KEY, "turn", "role", "text")
             .select(*_KEY, "turn", "initial", "blank", "first", "truncated", "n"))
    cells = dealt.mapInArrow(_spans, _SPAN)
    part = ["costs", "audits", "faults", "turns", "first", "last"]
    given = (conversations if ids is None else ids).select(
        F.col("conv_id").isNull().alias("no_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")
    ).distinct()
    stream = (cells.withColumn("tag", F.lit(1))
              .unionByName(given.withColumn("tag", F.lit(0)), allowMissingColumns=True)
              .unionByName(rows.select(*_KEY, "turn", "role", "text", "n", F.lit(2).alias("tag")),
                           allowMissingColumns=True))
    order = [*_KEY, "tag", "part", "turn", "role", "text"]
    return (stream.select(*order, "n", *part).repartition(*_KEY).sortWithinPartitions(*order)
            .mapInArrow(lambda it: _conversations(it, turns), schema))


def report(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` per conversation of ``ids`` (default: of the table).

    Rows are taken by turn (nulls first), then role, then text.  The first fault
    of a row counts: ``blank`` (white space alone), ``duplicate`` (role and text seen
    earlier in the conversation), ``truncated`` (does not end in ``.``, ``!`` or ``?``).
    ``illegal`` counts neighbours whose role initials do not follow each other,
    ``gaps`` the turn numbers missing between the lowest and the highest.  ``cost`` and
    ``audit`` are of the cheapest edits, ties to the smallest audit.

    Defined cases: a null role or text is one space; rows without conv_id form one
    conversation; equal rows are duplicates of the first; a conversation without
    rows has zeros, an empty audit and the digest of nothing; a role with another
    initial cannot be kept; other columns are ignored; an empty table gives no
    rows.  A conversation's rows are spread over tasks for parsing; the digest
    runs over them in order, so there one task streams them.  The audit has one
    letter per edit, so a conversation's edits, not its texts, must fit a task.
    """
    return _second_pass(conversations, ids, False,
                        "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                        "cost long, audit string, repaired_sha256 string")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired turns: ``conv_id, seq, edit, turn, role, text`` (``edit``: K kept, R
    with a new role, I inserted, which has a null turn and an empty text).  Cases as
    for ``report``; a conversation with nothing left has no rows."""
    return _second_pass(conversations, None, True,
                        "conv_id long, seq long, edit string, turn long, role string, text string")


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20
    (null: one space): 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3
    repeats the row, 4 makes it the user's."""
    def spaced(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"),
                                (F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20).alias("fault"))
    text = (F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.where("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy"))
            .drop("copy"))
