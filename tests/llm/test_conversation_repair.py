import hashlib
import itertools
import random
import re
import zlib

import pytest

from redeemflow.llm import conversation_repair as cr
from redeemflow.llm.oracles import OP11
from tools.oracle_check import rows_of

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def full_parse(kinds):
    """Every span and every split, as the textbook has it."""
    n = len(kinds)
    cell = {(i, i): cr.CLOSURE for i in range(n + 1)} | {(i, i + 1): cr.leaf(k) for i, k in enumerate(kinds)}
    for width in range(2, n + 1):
        for i in range(n - width + 1):
            options = []
            for k in range(i + 1, i + width):
                options += [(p, *x) for p, x in cr.join(cell[i, k], cell[k, i + width]).items()]
            cell[i, i + width] = cr._least(options)
    return cell[0, n]


def by_trial(kinds, most_inserted):
    """Cheapest audit by trying every edit string whose roles read as they should."""
    best = None
    for n in range(most_inserted + 1):
        for places in itertools.combinations(range(len(kinds) + n), n):
            for acts in itertools.product("DKR", repeat=len(kinds)):
                rows, audit, cost, roles = iter(zip(kinds, acts)), "", 0, [""]
                for i in range(len(kinds) + n):
                    if i in places:
                        audit, cost, new = audit + "I", cost + 3, "ua"
                    else:
                        kind, act = next(rows)
                        audit += act
                        cost += {"D": 4, "K": 0, "R": 3}[act] + (3 if kind.isupper() and act != "D" else 0)
                        new = {"D": [""], "K": kind.lower(), "R": "ua"}[act]
                        if kind == "x" and act != "D":
                            new = ""
                    roles = [r + x for r in roles for x in new]
                if any(re.fullmatch("(s?(ua)+)?", r) for r in roles):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def test_cells_equal_all_splits_and_all_edits():
    rng = random.Random(1)
    for n in range(5):
        for _ in range(12):
            kinds = "".join(rng.choices("suaoSUAOx", k=n))
            assert cr.cheapest(cr.parse([cr.leaf(k) for k in kinds])) == by_trial(kinds, 3), kinds
    for _ in range(60):
        kinds = "".join(rng.choices("suaoSUAOx", k=rng.randint(1, 25)))
        spans = cr.Spans()
        for k in kinds:
            spans.add(k, 0)
        assert full_parse(kinds) == cr.parse([cr.leaf(k) for k in kinds]) == spans.cell()


def plain(rows):
    """The report of one conversation's rows, by a left-to-right search."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for _, t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            count[fault] += 1
        kinds.append((role, text, fault))
    grown = {0: (0, "", ())}

    def insert(states):
        for _ in range(3):
            for p, (c, a, o) in list(states.items()):
                for role in ("user", "assistant"):
                    q = cr.MOVES[role[0]].get(p)
                    if q is not None:
                        new = (c + 3, a + "I", o + (f"{role}:",))
                        states[q] = min(states.get(q, new), new)
        return states
    for role, text, fault in kinds:
        states, after = insert(dict(grown)), []
        for p, (c, a, o) in states.items():
            after.append((p, (c + 4, a + "D", o)))
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                for r, act, extra in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    q = cr.MOVES.get(r[:1], {}).get(p)
                    if q is not None:
                        after.append((q, (c + more + extra, a + act, o + (f"{r}:{text}",))))
        grown = {}
        for q, x in after:
            grown[q] = min(grown.get(q, x), x)
    cost, audit, out = min(x for q, x in insert(grown).items() if q in (0, 3))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, count["blank"], count["duplicate"], count["truncated"],
            sum(a + b not in cr.LEGAL for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest()), out


def planted():
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["a.", "b", "", " \n", None, "c!", "é?", "x" * 30_000, "q.\r\n"]
    rows = []
    for conv in [*range(60), None, -5]:
        n = rng.randint(0, 9)
        rows += [(conv, rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    rows += [(200, i, rng.choice(roles[:3]), f"turn {rng.randint(0, 300)}" + rng.choice(".x")) for i in range(700)]
    rows += [(201, 4, "user", "same.")] * 500 + [(201, None, "assistant", "same.")] * 40
    rows += [(202, i, "user", "again.") for i in range(200)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return planted()


def frame(spark, rows):
    return (spark.createDataFrame(rows, SCHEMA).repartition(5)
            .selectExpr("*", "'x' as n", "1 as part", "2 as tag", "3 as conv", "'y' as first", "0 as early", "true as no_conv"))


def test_report_and_turns(spark, conversations):
    df = frame(spark, conversations)
    ids = spark.createDataFrame([(c,) for c in {r[0] for r in conversations} | {999}], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in cr.report(df, ids).collect()}
    assert set(got) == {r[0] for r in conversations} | {999}
    turns = {}
    for r in cr.repaired(df).collect():
        turns.setdefault(r.conv_id, []).append((r.seq, f"{r.role}:{r.text}"))
    for conv in got:
        want, out = plain([r for r in conversations if r[0] == conv])
        assert got[conv] == want, conv
        assert [t for _, t in sorted(turns.get(conv, []))] == list(out)
    assert got[999] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_conversation_over_many_tasks(spark, conversations):
    """A range of one row per task, so cells of one conversation meet from many."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [r for r in conversations if r[0] in (200, 201)]
        got = {r.conv_id: tuple(r)[1:] for r in cr.report(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {c: plain([r for r in rows if r[0] == c])[0] for c in (200, 201)}


def test_damage(spark):
    rows = [(c, t, "assistant", "Yes. No!") for c in (None, *range(40)) for t in (None, 0, 1)]
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else "Yes No" if k == 2 else text)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    got = [tuple(r) for r in cr.damage(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_planted_rows_against_sql(spark, conversations):
    import duckdb
    import pandas as pd
    rows = [r for r in conversations if r[0] is None or r[0] < 200]
    data = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", data)
    rel = con.sql(OP11)
    df = frame(spark, rows)
    got = cr.report(cr.damage(df), df.select("conv_id")).collect()
    assert rows_of([r.asDict() for r in got], COLUMNS) == rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], COLUMNS)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.report(empty).count() == 0 and cr.repaired(empty).count() == 0
