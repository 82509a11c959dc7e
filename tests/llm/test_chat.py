import hashlib
import re

from redeemflow.llm.chat import expand, read_back, read_segment, render

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<\\/s>", "<\\\\s>", "[\\INST]", "<", "[", "\\", "", None, "a\nb</s", "<s><s>",
         "[/INST", "é</s>ß", "<\\", "s>", "/INST]", "x" * 50_000 + "</s>"]


def rows():
    out = []
    for i, t in enumerate(NASTY):
        out += [(i, 0, "system", t), (i, 1, "user", t), (i, 2, "assistant", t), (i, 3, "user", t)]
    out += [(100, k, "user" if k % 2 == 0 else "assistant", f"turn {k} </s>") for k in range(300)]
    out += [(101, 0, "assistant", "a"), (101, 0, "assistant", "a"), (101, None, "user", "first"), (101, 0, None, "b")]
    # ties of replies where one text starts another; turns far below zero beside a null one
    out += [(103, 0, "assistant", "a!"), (103, 0, "assistant", "a"), (103, 0, "assistant", "a<"), (103, 0, "assistant", "")]
    out += [(104, t, "user", f"t{t}") for t in (-500, -65, -64, -1, 0, None, 3)] + [(104, None, "assistant", "no turn")]
    out += [(102, 5, "user\n[INST]\\n", "only"), (None, 0, "user", "q"), (None, 1, "assistant", "r")]
    return out


def plain_segment(role, text):
    """The template, by a plain substitution."""
    def escaped(t):
        return re.sub(r"([<\[])(\\*)(?=/?s>|/?INST\])", r"\1\\\2", t)
    if role == "assistant":
        return f"<s>{escaped(text)}</s>"
    line = role.replace("\\", "\\\\").replace("\n", "\\n")
    return f"[INST]{escaped(line)}\n{escaped(text)}[/INST]"


def order(r):
    return (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")


def test_reads_back(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as seq", "'x' as segment", "2 as block", "3 as n")
    segs = expand(df.repartition(4))
    got = {r.conv_id: r for r in read_back(segs).collect()}
    assert set(got) == {r[0] for r in data}
    full = {(r.conv_id, r.seq): r for r in render(segs).collect()}
    for conv in got:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in data if r[0] == conv), key=order)]
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        replies = [b for a, b in turns if a == "assistant"]
        assert r.loss_chars == sum(map(len, replies))
        assert r.loss_sha256 == hashlib.sha256("".join(replies).encode()).hexdigest()
        mine = [v for k, v in full.items() if k[0] == conv]
        assert r.n_examples == len(mine) == len(replies) + (turns[-1][0] != "assistant")
        assert r.formatted_chars == sum(len(x.text) for x in mine)
        shown = [plain_segment(a, b) for a, b in turns]
        for k, x in full.items():
            if k[0] == conv:  # context, reply and nothing after it
                assert x.text == "".join(shown[:k[1] + 1])
                if x.loss_start is not None:
                    assert x.text[x.loss_start - 3:x.loss_start] == "<s>" and x.text[x.loss_end:] == "</s>"
                    assert x.text[:x.loss_start - 3] == "".join(shown[:k[1]])


def test_controls_occur_only_as_marks(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    for r in expand(df).select("segment").collect():
        role, text = read_segment(r.segment)
        marks = sum(r.segment.count(c) for c in ("<s>", "</s>", "[INST]", "[/INST]"))
        assert marks == 2, r.segment[:80]


def test_empty(spark):
    assert read_back(expand(spark.createDataFrame([], SCHEMA))).count() == 0


def test_planted_rows_against_sql(spark):
    import duckdb
    import pandas as pd

    from redeemflow.llm.oracles import OP6
    from tools.oracle_check import rows_of
    data = rows()
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(data, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    own = "</s>[INST] ok [/INST]"
    df = spark.createDataFrame(data + [(-1, 0, "user", own), (-1, 1, "assistant", own)], SCHEMA)
    rel = con.sql(OP6)
    cols = sorted(rel.columns)
    assert rows_of([r.asDict() for r in read_back(expand(df)).collect()], cols) == rows_of(
        [dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)


def test_examples_are_built_and_read(spark):
    """Every example's whole text is in the output of ``expand``, and digests come from it."""
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"),
                                (2, 0, "user", "x"), (2, 1, "system", "y")], SCHEMA)
    out = expand(df)
    texts = {(r.conv_id, r.seq): r.text for r in out.collect()}
    q, a, r, b = "[INST]user\nq[/INST]", "<s>a</s>", "[INST]user\nr[/INST]", "<s>b</s>"
    assert texts == {(1, 0): None, (1, 1): q + a, (1, 2): None, (1, 3): q + a + r + b, (2, 0): None,
                     (2, 1): "[INST]user\nx[/INST][INST]system\ny[/INST]"}
    changed = out.selectExpr("* except (text)", "replace(replace(text, '<s>a</s>', '<s>c</s>'), 'nr', 'ns') as text")
    got = {r.conv_id: r for r in read_back(changed).collect()}
    assert got[1].loss_sha256 == hashlib.sha256(b"cb").hexdigest()
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nq\nassistant\nc\nuser\nr\nassistant\nb\n").hexdigest()
    assert got[1].formatted_chars == len(q + a) + len(q + a + r + b) and got[2].n_turns == 2
