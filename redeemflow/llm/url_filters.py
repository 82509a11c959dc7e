"""URL filter by redirect equivalence.

Pages that redirect to, or name as canonical, another address are the same
resource.  Addresses joined by such edges form classes (distributed connected
components); a rule that decides one address of a class decides its aliases.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import ascii_lower, connected_components, cut

#: rows of a rule table that may be broadcast (about 100 bytes each)
MAX_BROADCAST_RULES = 100_000

#: what declares nothing: comments, and the text of elements that hold no markup
_SILENT = (r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|iframe|xmp)(?=[\s/>])[^>]*+>.*?(?:</\1\s*+>|\z)")
#: a start tag with its quoted values whole; possessive, so its length needs no stack
_TAG = r"""(?is)<(?:%s)(?=[\s/])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_ATTRIBUTE = r"""(?s)([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+"""
_REFRESH = r"""(?is)^[\s\d.]*+[;,\s]\s*+(?:url\s*+=\s*+)?+(?:"([^"]*+)"?+|'([^']*+)'?+|(.*))"""
#: character references that addresses use by name (fixed values)
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def decoded(text: Column) -> Column:
    """``text`` with its character references replaced: all numeric ones, and those by name
    that addresses use.  Each is read once, so ``&amp;#38;`` gives ``&#38;``."""
    def one(piece):
        name = F.regexp_extract(piece, r"^&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|amp|lt|gt|quot|apos);?", 1)
        digits = F.when(F.lower(F.substr(name, F.lit(2), F.lit(1))) == "x", F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(
            F.substr(name, F.lit(2))).try_cast("int")
        digits = F.when(digits.between(1, 0xD7FF) | digits.between(0xE000, 0x10FFFF), digits)
        # a code point's four bytes are its UTF-32 form
        sign = F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32")
        for k, v in _NAMED.items():
            sign = F.when(name == k, v).otherwise(sign)
        rest = F.regexp_replace(piece, r"^&(?:#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|amp|lt|gt|quot|apos);?", "")
        return F.when((name != "") & sign.isNotNull(), F.concat(sign, rest)).otherwise(piece)
    return F.array_join(F.transform(F.split(text, "(?=&)"), one), "")


def attributes(tag: Column) -> Column:
    """Attributes of a start tag's inside: an array of (name, value), names lower-case,
    values decoded, without white space around them and line breaks inside."""
    parts = [F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), i) for i in range(1, 5)]
    pairs = F.arrays_zip(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    return F.transform(pairs, lambda x: F.struct(
        ascii_lower(x["p0"]).alias("name"),
        F.trim(F.regexp_replace(decoded(F.concat(x["p1"], x["p2"], x["p3"])), r"[\t\r\n\f]++", " ")).alias("value")))


def _value(found: Column, name: str) -> Column:
    """The value of the first attribute of that name; null without one."""
    return F.get(F.filter(found, lambda x: x["name"] == name), 0)["value"]


def declared(pages: DataFrame) -> DataFrame:
    """``pages`` with ``to``, the targets of their canonical links and refresh redirects, and
    ``base``, their base address (null without one)."""
    pages = pages.withColumn("_loud", F.regexp_replace("html", _SILENT, " "))
    for name in ("link", "meta", "base"):
        pages = pages.withColumn(f"_{name}", F.transform(
            F.regexp_extract_all("_loud", F.lit(_TAG % name), 1), attributes))
    links = F.transform(F.filter("_link", lambda a: F.array_contains(
        F.split(ascii_lower(F.coalesce(_value(a, "rel"), F.lit(""))), r"\s+"), "canonical")), lambda a: _value(a, "href"))
    jumps = F.transform(F.filter("_meta", lambda a: ascii_lower(_value(a, "http-equiv")) == "refresh"), lambda a: F.trim(
        F.concat(*[F.coalesce(F.regexp_extract(_value(a, "content"), _REFRESH, i), F.lit("")) for i in (1, 2, 3)])))
    base = F.get(F.filter(F.transform("_base", lambda a: _value(a, "href")), lambda x: x.isNotNull()), 0)
    return pages.withColumns({"to": F.filter(F.concat(links, jumps), lambda x: F.coalesce(x, F.lit("")) != ""), "base": base})


def with_address(df: DataFrame, url: Column, prefix: str = "") -> DataFrame:
    """Add ``host`` (text after the first ``://`` up to ``/``, ``?`` or ``#``,
    A-Z lower-cased) and ``path`` (then up to ``?`` or ``#``) of a url; both
    empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return (df.withColumn("_rest", rest)
            .withColumn(prefix + "host", ascii_lower(F.regexp_extract("_rest", r"^[^/?#]*", 0)))
            .withColumn(prefix + "path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
            .drop("_rest"))


def without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments resolved (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"),
        lambda a, x: F.when(x == ".", a)
        .when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))
        .otherwise(F.concat(a, F.array(x))))
    # a last segment of dots names a folder
    kept = F.when(path.rlike(r"/\.\.?$"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def _resolved(to: Column, host: Column, path: Column) -> Column:
    """``to`` as an address with a scheme, seen from a page at ``host`` and ``path``."""
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    return (F.when(to.rlike(r"^[^/?#]*://"), to)
            .when(F.startswith(to, F.lit("//")), F.concat(F.lit("x:"), to))
            .when(F.startswith(to, F.lit("/")), F.concat(F.lit("x://"), host, to))
            .when(to.rlike(r"^([?#]|$)"), F.concat(F.lit("x://"), host, path, to))
            .otherwise(F.concat(F.lit("x://"), host, F.when(folder == "", F.lit("/")).otherwise(folder), to)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges ``(u_host, u_path, v_host, v_path)`` that pages declare by their
    canonical links and refresh redirects, all of them.  Tags are read attribute by
    attribute, outside comments and scripts, character references decoded.  Targets
    without a scheme are resolved against the page's base element or own address, and
    dot segments of any target."""
    low = F.lower(F.coalesce("html", F.lit("")))
    rows = pages.where(F.contains(low, F.lit("canonical")) | F.contains(low, F.lit("http-equiv")) | F.contains(low, F.lit("&#")))
    rows = with_address(declared(rows.select("url", "html")).select("url", "to", "base"), F.col("url"), "u_").where("u_host <> ''")
    rows = rows.select("u_host", "u_path", "base", F.explode("to").alias("to"))
    rows = with_address(rows, F.when(F.col("base").isNotNull(), _resolved(F.col("base"), F.col("u_host"), F.col("u_path"))), "b_")
    host = F.when(F.col("b_host") == "", F.col("u_host")).otherwise(F.col("b_host"))
    path = F.when(F.col("b_host") == "", F.col("u_path")).otherwise(F.col("b_path"))
    return (with_address(rows.withColumn("full", _resolved(F.col("to"), host, path)), F.col("full"), "v_")
            .withColumn("v_path", without_dots(F.col("v_path")))
            .where("v_host <> '' and not (u_host = v_host and u_path = v_path)")
            .select("u_host", "u_path", "v_host", "v_path").distinct())


def match_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` of every node that some rule fits.

    ``rules`` has ``host, path, verdict`` (allow or block).  A rule fits its
    host and all subdomains if the node's path starts with the rule's.  The
    longest rule (host + path) wins; equal length: the longer host, then
    allow.  Every node looks up (host suffix, path prefix) keys, the prefixes
    at the lengths that rules of that host have, so no node meets a rule that
    does not fit it.
    """
    rules = (rules.where("host is not null and host <> '' and verdict in ('allow', 'block')")
             .select(ascii_lower(F.col("host")).alias("r_host"),
                     F.coalesce("path", F.lit("")).alias("r_path"), "verdict")
             .groupBy("r_host", "r_path").agg(F.min("verdict").alias("rule_verdict")))
    lengths = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lens"))
    if rules.count() <= MAX_BROADCAST_RULES:
        rules, lengths = F.broadcast(rules), F.broadcast(lengths)
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))
    hits = (nodes.where("host <> ''")
            .select("host", "path", F.explode(F.array_distinct(suffixes)).alias("r_host"))
            .join(lengths, "r_host")
            .select("host", "path", "r_host", F.explode("lens").alias("n"))
            .where(F.length("path") >= F.col("n"))
            .withColumn("r_path", F.substr("path", F.lit(1), F.col("n")))
            .join(rules, ["r_host", "r_path"]))
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(rule).alias("a"), F.length("r_host").alias("b"),
                          rule.alias("rule"), "rule_verdict"))
    return (hits.groupBy("host", "path").agg(best.alias("x"))
            .select("host", "path", "x.rule", "x.rule_verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, class_id, verdict`` for every row of ``pages``.

    ``verdict`` is the fitting rule's; without one it is that of the address
    class: allow if any alias is explicitly allowed (allow takes precedence),
    else block if any alias is blocked, else allow.  ``class_id`` is the
    smallest address of the class (null outside classes).

    An address is host and path.  Rules are about paths and the class is named by
    one, so the query string is no part of it on either side: ``?id=1`` and
    ``?id=2`` of a script are one address, and an edge of one is an edge of both.

    Defined cases: null url or no ``://`` gives empty host and path, no rule,
    allow.  Repeated rows and urls each keep their row.  Null html declares no
    edges.  Other columns are ignored.  Empty tables give no rows.
    """
    rows = with_address(pages.select("page_id", "url"), F.col("url")).drop("url")
    edges = cut(alias_edges(pages))
    node = lambda h, p: F.concat(F.col(h), F.col(p))  # noqa: E731  a host has no slash
    classes = connected_components(edges.select(node("u_host", "u_path").alias("u"),
                                                node("v_host", "v_path").alias("v")))
    ends = (edges.select(F.col("u_host").alias("host"), F.col("u_path").alias("path"))
            .unionByName(edges.select(F.col("v_host").alias("host"), F.col("v_path").alias("path"))))
    nodes = rows.select("host", "path").unionByName(ends).distinct()
    ruled = match_rules(nodes, rules)
    members = (ends.distinct().join(ruled, ["host", "path"], "left")
               .withColumn("node", F.concat("host", "path")).join(classes, "node"))
    decided = members.groupBy("component").agg(
        F.max((F.coalesce("rule_verdict", F.lit("")) == "allow")).alias("any_allow"),
        F.max((F.coalesce("rule_verdict", F.lit("")) == "block")).alias("any_block"))
    by_class = (members.select("host", "path", "component").join(decided, "component")
                .select("host", "path", F.col("component").alias("class_id"),
                        F.when(F.col("any_allow"), "allow").when(F.col("any_block"), "block")
                        .alias("class_verdict")))
    return (rows.join(ruled, ["host", "path"], "left").join(by_class, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", "class_id",
                    F.coalesce("rule_verdict", "class_verdict", F.lit("allow")).alias("verdict")))
