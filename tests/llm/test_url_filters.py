import random

import pytest
from pyspark.sql import functions as F

from redeemflow.llm.common import connected_components
from redeemflow.llm.url_filters import decoded, filter_urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("bad.net", "", "block"), ("good.net", "/x", "allow"),
         ("tie.io", "/a", "block"), ("tie.io", "/a", "allow")]
RULE_SCHEMA = "host string, path string, verdict string"


def canon(href):
    return f'<html><link href="{href}" rel="canonical"></html>'


def run(spark, pages, rules=RULES):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "*", "'x' as host", "'y' as path", "'z' as rule", "1 as n")
    got = filter_urls(df, spark.createDataFrame(rules, RULE_SCHEMA)).collect()
    return sorted(got, key=lambda r: (r.page_id is None, r.page_id or 0))


def test_parts_and_rules(spark):
    pages = [(1, "http://A.Example.ORG/es/1?q#f", None), (2, "https://example.org/en/", ""),
             (3, "http://xcom/fr/1", None), (4, "http://m.site.com/de/1", None), (5, None, "<p>"),
             (6, "no scheme", None), (7, "http://example.org?x", None), (8, "http://tie.io/ab", None),
             (1, "http://A.Example.ORG/es/1?q#f", None), (9, "", None), (10, "http://bad.net.evil/", None)]
    got = run(spark, pages)
    by = {r.page_id: r for r in got}
    assert len(got) == len(pages)
    assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert (by[2].rule, by[2].verdict) == ("org/", "allow")
    assert (by[3].host, by[3].rule, by[3].verdict) == ("xcom", None, "allow")
    assert (by[4].rule, by[4].verdict) == ("com/de/", "block")
    for k in (5, 6, 9):
        assert (by[k].host, by[k].path, by[k].rule, by[k].verdict) == ("", "", None, "allow")
    assert (by[7].host, by[7].path, by[7].rule) == ("example.org", "", None)
    assert by[8].verdict == "allow"
    assert by[10].rule is None


def test_block_reaches_aliases_and_allow_wins(spark):
    pages = [(1, "http://a.net/1", canon("http://b.net/2")),           # a1 - b2 - bad.net
             (2, "http://b.net/2", '<META content="0; URL=http://bad.net/z" http-equiv="refresh">'),
             (3, "http://c.net/3", canon("/4?utm=1")),                  # relative: c.net/4, no rule
             (4, "http://d.net/5", canon("//bad.net/q")),               # d5 - bad.net/q - e6 - good.net/x
             (5, "http://e.net/6", canon("http://bad.net/q")),
             (6, "http://e.net/6", canon("http://good.net/xyz")),
             (7, "http://good.net/xyz", None), (8, "http://bad.net/q", None),
             (9, "http://f.net/dir/p", canon("q")), (10, "http://f.net/dir/q", canon("http://bad.net"))]
    by = {r.page_id: r for r in run(spark, pages)}
    assert by[1].verdict == by[2].verdict == "block" and by[1].class_id == by[2].class_id == "a.net/1"
    assert by[3].verdict == "allow" and by[3].class_id == "c.net/3"
    assert by[4].verdict == by[5].verdict == by[6].verdict == "allow"
    assert by[7].verdict == "allow" and by[8].verdict == "block"  # their own rules
    assert by[9].verdict == by[10].verdict == "block"


def test_every_form_of_an_edge(spark):
    refresh = '<meta http-equiv="refresh" content="{}">'
    pages = [(1, "http://a.net/1", refresh.format("0; url='http://bad.net/a'")),
             (2, "http://a.net/2", "<meta http-equiv=refresh content='0; URL=\"http://bad.net/b\"'>"),
             (3, "http://a.net/3", canon("http://n.net/") + canon("http://bad.net/c")),         # the second link
             (4, "http://a.net/4", refresh.format("0; url=http://n.net/x") + refresh.format("0; url=http://bad.net/d")),
             (5, "http://b.net/x/y/5", canon("../z/./6")), (6, "http://b.net/x/z/6", canon("http://bad.net/e")),
             (7, "http://b.net/x/y/7", canon("./8?q=..")), (8, "http://b.net/x/y/8", canon("http://bad.net/f")),
             (9, "http://c.net/9", canon("/k/l/../../../m/..")), (10, "http://c.net/", canon("http://bad.net/g")),
             (11, "http://d.net/11", canon("http://d.net/q/../12")), (12, "http://d.net/12", canon("http://bad.net/h")),
             # one script is one address, whatever its query string
             (13, "http://s.net/r?id=1", canon("http://bad.net/i")), (14, "http://s.net/r?id=2", None),
             (15, "http://s.net/r..", canon("t..u"))]
    by = {r.page_id: r for r in run(spark, pages)}
    assert [k for k in range(1, 15) if by[k].verdict != "block"] == []
    assert by[15].verdict == "allow" and by[15].class_id == "s.net/r.."


def test_empty_tables(spark):
    assert run(spark, []) == []
    got = run(spark, [(1, "http://a.org/", canon("http://b.org/"))], [])
    assert got[0].verdict == "allow" and got[0].rule is None


@pytest.mark.parametrize("seed", range(3))
def test_components_match_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(70 + i, 71 + i) for i in range(40)]
    edges += [(200, 201 + i) for i in range(30)] + [(None, 3), (5, 5)]
    root = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        if u is not None and v is not None:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    linked = {x for u, v in edges if u is not None and v is not None and u != v for x in (u, v)}
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for x in linked}
    assert len(got) == len(linked)


#: forms that declare an edge to bad.net/z, whose rule blocks
EDGES = [
    '<link data-href="/no" rel="canonical" href="http://bad.net/z">',
    """<link title="a > b" rel=canonical href='http://bad.net/z'>""",
    '<link rel="canonical" href="http://bad.net&#47;z">', '<link rel="canonical" href="http&colon;//no" href="x"><link rel=canonical href="http:&#x2F;&#x2f;bad.net/z">',
    '<base href="http://bad.net/q/r"><link rel="canonical" href="../z">', '<link rel="canonical" href="  http://bad.net/z\n ">',
    '<link rel="nofollow canonical" href="//bad.net/z">', '<LINK HREF="http://bad.net/./a/../z" REL="Canonical"/>',
    """<meta http-equiv="refresh" content="0; url='http://bad.net/z'">""", '<meta content="5,http://bad.net/z" http-equiv=refresh>',
    '<meta http-equiv="Refresh" content="0;URL=&quot;http://bad.net/z&quot;">', '<base href="//bad.net"><meta http-equiv=refresh content="0; url=z">',
]
#: forms that declare none
SILENT = [
    '<!-- <link rel="canonical" href="http://bad.net/z"> -->', '<script>var x = \'<link rel="canonical" href="http://bad.net/z">\'</script>',
    '<style><link rel="canonical" href="http://bad.net/z"></style>', '<!-- open <link rel="canonical" href="http://bad.net/z">',
    '<link rel="canonicals" href="http://bad.net/z">', '<linked rel="canonical" href="http://bad.net/z">',
    '<link rel="stylesheet" title="canonical" href="http://bad.net/z">', '<meta http-equiv="refresh" content="30">',
    '<link rel="canonical" data-href="http://bad.net/z">', '<meta name="refresh" content="0; url=http://bad.net/z">', '<link rel="canonical">',
    '<textarea><link rel="canonical" href="http://bad.net/z"></textarea>',
]


def test_forms_of_edges(spark):
    pages = [(i, f"http://p{i}.net/a", h) for i, h in enumerate(EDGES + SILENT)]
    got = run(spark, pages)
    assert [r.page_id for r in got if r.verdict == "block"] == list(range(len(EDGES)))


def test_long_tags_and_pages_end(spark):
    many = "<link " + "a='b' " * 50_000 + 'rel="canonical" href="http://bad.net/z">'
    half = "<link rel='canonical' href='" + "x" * 100_000
    pages = [(0, "http://a.net/", many), (1, "http://b.net/", half), (2, "http://c.net/", "<script>canonical" * 5000),
             (3, "http://d.net/", "<!-- canonical" + " x" * 300_000)]
    assert [r.verdict for r in run(spark, pages)] == ["block", "allow", "allow", "allow"]


def test_references(spark):
    cases = ["a&amp;b", "&amp;#38;", "&#38;&#x26;", "&#8364;&#x1F600", "&unknown;&", "&#0;&#xD800;", "", "&lt&gt;&quot;&apos;", "&#99999999;"]
    want = ["a&b", "&#38;", "&&", "\u20ac\U0001f600", "&unknown;&", "&#0;&#xD800;", "", "<>\"'", None]
    got = [r.x for r in spark.createDataFrame([(c,) for c in cases], "t string").select(decoded(F.col("t")).alias("x")).collect()]
    assert got[:-1] == want[:-1]


def test_planted_pages_against_sql(spark):
    import duckdb
    import pandas as pd

    from redeemflow.llm.oracles import OP2
    from redeemflow.llm.queries import URL_RULES
    from tools.oracle_check import rows_of
    blocked = [h.replace("bad.net/q/r", "x.com/de/q/r").replace("bad.net", "x.com/de") for h in EDGES + SILENT]
    pages = [(i, f"http://p{i}.net/a/b", h) for i, h in enumerate(blocked)]
    pages += [(100, "http://x.com/de/z", None), (101, "http://x.com/fr/1", '<link rel=canonical href="/de/./y">'), (102, None, "<p>"),
              (103, "http://q.org/1", '<link rel="canonical" href="http://k.io/../a/.././b/..">'), (104, "http://k.io/", None)]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]))
    rel = con.sql(OP2)
    cols = sorted(rel.columns)
    got = run(spark, pages, URL_RULES)
    assert rows_of([r.asDict() for r in got], cols) == rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols)
    assert sum(r.verdict == "block" for r in got) > len(EDGES) // 2
