"""DuckDB SQL of the queries that SQL can express."""

OP2 = r"""
WITH RECURSIVE rules(r_host, r_path, r_verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, coalesce(html, '') AS html,
  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, html,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
loud AS (SELECT host, path, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script(?:[\s/][^>]*)?>.*?(?:</script\s*>|\z)|<style(?:[\s/][^>]*)?>.*?(?:</style\s*>|\z)|<textarea(?:[\s/][^>]*)?>.*?(?:</textarea\s*>|\z)|<title(?:[\s/][^>]*)?>.*?(?:</title\s*>|\z)|<iframe(?:[\s/][^>]*)?>.*?(?:</iframe\s*>|\z)|<xmp(?:[\s/][^>]*)?>.*?(?:</xmp\s*>|\z)', ' ', 'g') AS html
  FROM p WHERE host <> ''),
tags AS (SELECT host, path, lower(regexp_extract(t, '^<([a-zA-Z]+)', 1)) AS tag,
    row_number() OVER () AS n, regexp_replace(t, '^<[a-zA-Z]+|>$', '', 'g') AS t FROM (
  SELECT host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta|base)[\s/](?:[^>"'']|"[^"]*"|''[^'']*'')*>')) AS t FROM loud)),
pieces AS (SELECT host, path, tag, n, unnest(regexp_extract_all(t, '(?s)[^\s"''>/=]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+))?')) AS a,
  generate_subscripts(regexp_extract_all(t, '(?s)[^\s"''>/=]+(?:\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+))?'), 1) AS k FROM tags),
raw AS (SELECT host, path, tag, n, k, lower(regexp_extract(a, '^[^\s=]+', 0)) AS name,
  regexp_replace(regexp_replace(a, '(?s)^[^\s=]+(\s*=\s*)?', ''), '(?s)^"(.*)"$|^''(.*)''$', '\1\2') AS v FROM pieces),
plain AS (SELECT host, path, tag, n, k, name, trim(regexp_replace(array_to_string(list_transform(list_zip(
    list_prepend('', list_transform(string_split(v, '&')[2:], lambda x: '&' || x)), string_split(v, '&')[1:1]),
  lambda z: CASE WHEN z[1] IS NULL OR z[1] = '' THEN coalesce(z[2], '') ELSE coalesce(
    CASE regexp_extract(z[1], '^&(amp|lt|gt|quot|apos)', 1) WHEN 'amp' THEN '&' WHEN 'lt' THEN '<' WHEN 'gt' THEN '>'
      WHEN 'quot' THEN '"' WHEN 'apos' THEN '''' END || regexp_replace(z[1], '^&[a-z]+;?', ''),
    CASE WHEN regexp_matches(z[1], '^&#[0-9]{1,7}') THEN chr(CAST(regexp_extract(z[1], '^&#([0-9]+)', 1) AS INTEGER))
      WHEN regexp_matches(z[1], '^&#[xX][0-9a-fA-F]{1,6}') THEN chr(CAST(list_reduce(list_prepend(0, list_transform(
        string_split(lower(regexp_extract(z[1], '^&#[xX]([0-9a-fA-F]+)', 1)), ''), lambda d: strpos('0123456789abcdef', d) - 1)),
        lambda x, y: x * 16 + y) AS INTEGER)) END || regexp_replace(z[1], '^&#[xX]?[0-9a-fA-F]+;?', ''), z[1]) END), ''),
  '[\t\r\n\f]+', ' ', 'g')) AS v FROM raw),
attr AS (SELECT host, path, tag, n, name, arg_min(v, k) AS v FROM plain GROUP BY ALL),
tagged AS (SELECT host, path, tag, n, max(v) FILTER (name = 'href') AS href, max(v) FILTER (name = 'rel') AS rel,
  max(v) FILTER (name = 'content') AS content, max(v) FILTER (name = 'http-equiv') AS equiv FROM attr GROUP BY ALL),
bases AS (SELECT host, path, arg_min(href, n) AS b FROM tagged WHERE tag = 'base' AND href IS NOT NULL GROUP BY ALL),
targets AS (SELECT host, path, CASE WHEN tag = 'link' THEN href ELSE
    trim(regexp_replace(regexp_extract(content, '(?is)^[\s\d.]*[;,\s]\s*(?:url\s*=\s*)?(.*)', 1), '(?s)^"([^"]*)"?.*$|^''([^'']*)''?.*$', '\1\2')) END AS t
  FROM tagged WHERE (tag = 'link' AND list_contains(string_split_regex(lower(coalesce(rel, '')), '\s+'), 'canonical'))
    OR (tag = 'meta' AND lower(equiv) = 'refresh')),
seen AS (SELECT host, path, t, split_part(CASE WHEN b IS NULL THEN host || path ELSE bf END, '?', 1) AS here FROM targets LEFT JOIN (
  SELECT host, path, b, CASE WHEN regexp_matches(b, '^[^/?#]*://') THEN substr(b, strpos(b, '://') + 3) WHEN starts_with(b, '//') THEN substr(b, 3)
    WHEN starts_with(b, '/') THEN host || b ELSE host || CASE WHEN strpos(path, '/') = 0 THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || b END AS bf
  FROM bases) USING (host, path) WHERE t <> ''),
full_url AS (SELECT host, path, CASE
    WHEN regexp_matches(t, '^[^/?#]*://') THEN substr(t, strpos(t, '://') + 3)
    WHEN starts_with(t, '//') THEN substr(t, 3)
    WHEN starts_with(t, '/') THEN regexp_extract(here, '^[^/]*', 0) || t
    WHEN regexp_matches(t, '^[?#]') THEN here || t
    ELSE CASE WHEN strpos(here, '/') = 0 THEN here || '/' ELSE regexp_extract(here, '^(.*/)', 1) END || t END AS f FROM seen),
joined AS (SELECT host || path AS u,
    translate(regexp_extract(f, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS vh,
    regexp_extract(f, '^[^/?#]*([^?#]*)', 1) AS vp FROM full_url WHERE NOT regexp_matches(f, '^[/?#]|^$')),
ends AS (SELECT u, vh || CASE WHEN regexp_matches(vp, '/\.\.?(/|$)') THEN '/' || array_to_string(list_reduce(
      list_prepend([]::VARCHAR[], list_transform(string_split(vp, '/')[2:], lambda x: [x])),
      lambda a, x: CASE x[1] WHEN '.' THEN a WHEN '..' THEN a[1:len(a) - 1] ELSE list_concat(a, x) END)
      || CASE WHEN regexp_matches(vp, '/\.\.?$') THEN [''] ELSE [] END, '/') ELSE vp END AS v FROM joined),
e AS (SELECT u, v FROM ends WHERE u <> v UNION SELECT v, u FROM ends WHERE u <> v),
reach(node, other) AS (SELECT u, u FROM e UNION SELECT r.node, e.v FROM reach r JOIN e ON e.u = r.other),
class AS (SELECT node, min(other) AS class_id FROM reach GROUP BY node),
nodes AS (SELECT host, path, host || path AS node FROM p UNION
  SELECT regexp_extract(node, '^([^/]*)', 1), regexp_extract(node, '^[^/]*(.*)$', 1, 's'), node FROM class),
ruled AS (SELECT node, r_host || r_path AS rule, r_verdict FROM nodes JOIN rules
  ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, r_verdict) = 1),
decided AS (SELECT class_id, bool_or(r_verdict = 'allow') AS any_allow, bool_or(r_verdict = 'block') AS any_block
  FROM class LEFT JOIN ruled USING (node) GROUP BY class_id)
SELECT page_id, host, path, rule, class_id, coalesce(r_verdict,
    CASE WHEN any_allow THEN 'allow' WHEN any_block THEN 'block' END, 'allow') AS verdict
FROM p LEFT JOIN ruled ON ruled.node = host || path LEFT JOIN class ON class.node = host || path
  LEFT JOIN decided USING (class_id)
"""

OP3 = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:least(i + 9, len(w))] AS ww FROM
  (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(ww) AS n FROM win),
occ AS (SELECT doc_id, i, n, w[i:i + n - 1] AS ww FROM
  (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM occ JOIN win USING (ww)),
words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM
  (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

OP6 = r"""
WITH c AS (SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS line FROM (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
s AS (SELECT *, row_number() OVER w AS seq, role = 'assistant' AS target, count(*) OVER (PARTITION BY conv_id) AS n_turns,
    sum(CASE WHEN role = 'assistant' THEN 7 ELSE 14 + length(line) + len(regexp_extract_all(line, '[<\[]\\*(?:/?s>|/?INST\])')) END
      + length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\])'))) OVER w AS e
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, any_value(n_turns) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (target), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY seq) FILTER (target), '')) AS loss_sha256,
  CAST(sum(e) FILTER (target OR seq = n_turns) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (target OR seq = n_turns) AS BIGINT) AS n_examples
FROM s GROUP BY conv_id
"""

OP9 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
b AS (SELECT doc_id, hx, CAST(length(hx) // 2 AS BIGINT) AS n FROM d),
w AS (SELECT doc_id, i, substr(hx, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, hx, unnest(range(0, n - 49)) AS i FROM b WHERE n >= 50)),
low AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
gone AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM w JOIN low USING (s) WHERE first_id < doc_id),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM gone),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 50 AS e FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS done FROM spans),
cuts AS (SELECT doc_id, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans, max(e) AS last,
    string_agg(substr(hx, 2 * done + 1, 2 * (s - done)), '' ORDER BY s) AS head
  FROM gaps JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN last IS NULL THEN hx ELSE head || substr(hx, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN cuts USING (doc_id)
"""

OP11 = r"""
WITH RECURSIVE base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda c: CAST(ord(c) AS BIGINT)) AS bytes FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes),
    lambda h, b: list_reduce(list_prepend(xor(h, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT))), 4294967295::BIGINT) % 20 AS k FROM base),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE k <> 0),
placed AS (SELECT conv_id, turn, role, text, left(role, 1) AS r, rtrim(text, E' \t\n\x0b\x0c\r') AS t,
    row_number() OVER w AS pos, lag(left(role, 1)) OVER w AS before
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, CASE WHEN t = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1
    THEN 'duplicate' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
ins(p, q, cost, audit, added) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']),
  (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:'])),
moves(r, role, p, q) AS (VALUES ('s', 'system', 0, 1), ('u', 'user', 0, 2), ('u', 'user', 1, 2), ('u', 'user', 3, 2),
  ('a', 'assistant', 2, 3)),
acts AS (
  SELECT conv_id, pos, p, p AS q, 4 AS cost, 'D' AS audit, []::VARCHAR[] AS added FROM judged, unnest([0, 1, 2, 3]) AS s(p)
  UNION ALL SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, 'K', [judged.role || ':' || text]
    FROM judged JOIN moves USING (r) WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL SELECT conv_id, pos, p, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R', [moves.role || ':' || text]
    FROM judged, moves WHERE fault NOT IN ('blank', 'duplicate') AND moves.r <> 's'),
steps AS (SELECT conv_id, pos, ins.p, acts.q, ins.cost + acts.cost AS cost, ins.audit || acts.audit AS audit,
    list_concat(ins.added, acts.added) AS added FROM acts JOIN ins ON ins.q = acts.p),
path(conv_id, pos, place, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'added': []::VARCHAR[]} FROM conversations
  UNION ALL SELECT path.conv_id, steps.pos, steps.q, min({'cost': best.cost + steps.cost, 'audit': best.audit || steps.audit,
      'added': list_concat(best.added, steps.added)})
    FROM path JOIN steps ON steps.conv_id IS NOT DISTINCT FROM path.conv_id AND steps.pos = path.pos + 1 AND steps.p = path.place
    GROUP BY path.conv_id, steps.pos, steps.q),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ends AS (SELECT path.conv_id, min({'cost': best.cost + ins.cost, 'audit': best.audit || ins.audit,
    'added': list_concat(best.added, ins.added)}) AS best
  FROM path LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM path.conv_id JOIN ins ON ins.p = place AND ins.q IN (0, 3)
  WHERE path.pos = coalesce(n, 0) GROUP BY path.conv_id)
SELECT ends.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(best.cost AS BIGINT) AS cost, best.audit AS audit, sha256(array_to_string(best.added, chr(10))) AS repaired_sha256
FROM ends LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ends.conv_id
"""

_GRIDS = {"symbols_per_word": "0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0",
          "upper_share": "0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9",
          "marks_per_word": "0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0",
          "repeat_share": "0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5",
          "dup_line_share": "0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9"}
_STEP = "least(" + ", ".join(f"10 - len(list_filter([{g}]::DOUBLE[], lambda c: {r} > c))" for r, g in _GRIDS.items()) + ")"

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text, text AS raw FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tri AS (SELECT k, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS t
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 3)) AS p FROM (
  SELECT k, i, count(*) OVER (PARTITION BY k, t) AS times FROM tri) WHERE times > 1) GROUP BY k),
counts AS (SELECT w.k, doc_id, stratum, raw, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_n, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
    length(regexp_replace(text, '[^!?]', '', 'g')) AS marks, len(lines) AS n_lines FROM w LEFT JOIN rep USING (k)),
f AS (SELECT *, n_symbols / greatest(n_words, 1) AS symbols_per_word, upper_n / greatest(letters, 1) AS upper_share,
    marks / greatest(n_words, 1) AS marks_per_word, n_repeat_words / greatest(n_words, 1) AS repeat_share,
    n_dup_lines / greatest(n_lines, 1) AS dup_line_share FROM counts),
s AS (SELECT *, """ + _STEP + r""" AS step, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
known AS (SELECT doc_id, min(quality) AS worst FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
trials AS (SELECT stratum, raw, min(step) AS step FROM s JOIN known USING (doc_id) GROUP BY stratum, raw HAVING min(worst) = 1),
sizes AS (SELECT stratum, count(*) AS n, 0.05 / (SELECT count(DISTINCT stratum) FROM trials) AS level FROM trials GROUP BY stratum),
tests AS (SELECT stratum, t, n, level, (SELECT count(*) FROM trials x WHERE x.stratum = z.stratum AND x.step <= t) AS bad
  FROM sizes z, unnest(range(0, 10)) AS r(t)),
passed AS (SELECT stratum, t, bad / n < 0.05 AND list_sum(list_transform(range(0, bad + 1), lambda i:
    exp(lgamma(n + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))) <= level AS ok
  FROM tests),
walked AS (SELECT stratum, max(t) AS last FROM (SELECT stratum, t, bool_and(ok) OVER (PARTITION BY stratum ORDER BY t) AS ok FROM passed)
  WHERE ok GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (last IS NULL OR step > last) AS kept, stratum, symbols_per_word, upper_share, marks_per_word, repeat_share, dup_line_share
FROM s LEFT JOIN walked USING (stratum)
"""

# XXH64 in SQL: 128-bit products modulo 2^64.  Fixed values: the five primes of the hash.
_M = "18446744073709551616::UHUGEINT"
_P1, _P2, _P3, _P4, _P5 = (f"{p}::UHUGEINT" for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _bound(value: str, name: str, then: str) -> str:
    """``then`` with ``name`` standing for ``value``, computed once."""
    return f"list_transform([{value}], lambda {name}: {then})[1]"


def _mul(a: str, b: str) -> str:
    return f"(({a}) * {b}) % {_M}"


def _add(a: str, b: str) -> str:
    return f"(({a}) + {b}) % {_M}"


def _xor(a: str, b: str) -> str:
    return f"xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT))::UHUGEINT"


def _turn(x: str, r: int) -> str:
    return _bound(x, f"t{r}", f"(t{r} * {1 << r}::UHUGEINT) % {_M} + t{r} // {1 << (64 - r)}::UHUGEINT")


def _fold(x: str, r: int) -> str:
    return _bound(x, f"f{r}", _xor(f"f{r}", f"f{r} // {1 << r}::UHUGEINT"))


def _round(acc: str, lane: str) -> str:
    return _mul(_turn(_add(acc, _mul(lane, _P2)), 31), _P1)


def _lanes(width: int, first: str, count: str) -> str:
    """Little-endian numbers of ``width`` bytes of the hex text ``hx``, from byte ``first`` on."""
    number = " + ".join(f"CAST(strpos('0123456789ABCDEF', substr(hx, 2 * o + {2 * i + 1}, 1)) - 1 AS UHUGEINT) * {16 << (8 * i)}::UHUGEINT"
                        f" + CAST(strpos('0123456789ABCDEF', substr(hx, 2 * o + {2 * i + 2}, 1)) - 1 AS UHUGEINT) * {1 << (8 * i)}::UHUGEINT"
                        for i in range(width))
    return f"list_transform(list_transform(range(0, {count}), lambda j: {first} + j * {width}), lambda o: {number})"


_START = [f"{(42 + 11400714785074694791 + 14029467366897019727) % 2 ** 64}::UHUGEINT", f"{(42 + 14029467366897019727) % 2 ** 64}::UHUGEINT",
          "42::UHUGEINT", f"{(42 - 11400714785074694791) % 2 ** 64}::UHUGEINT"]
_STRIPES = ("list_reduce(list_prepend([" + ", ".join(_START) + "], list_transform(range(0, n // 32), lambda j: w8[4 * j + 1:4 * j + 4])), "
            "lambda v, x: [" + ", ".join(_round(f"v[{i}]", f"x[{i}]") for i in range(1, 5)) + "])")
_MERGED = " + ".join(_turn(f"v[{i}]", r) for i, r in zip(range(1, 5), (1, 7, 12, 18)))


def _merge(h: str, i: int) -> str:
    return _add(_mul(_xor(h, _round("0::UHUGEINT", f"v[{i}]")), _P1), _P4)


_LONG = _merge(_merge(_merge(_merge(f"(({_MERGED}) % {_M})", 1), 2), 3), 4)

OP5 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sh AS (SELECT k, array_to_string(words[i:i + 2], ' ') AS t FROM (
  SELECT k, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM d WHERE len(words) > 0)),
b AS (SELECT t, hex(encode(t)) AS hx, CAST(strlen(t) AS BIGINT) AS n FROM (SELECT DISTINCT t FROM sh)),
lanes AS (SELECT t, hx, n, """ + _lanes(8, "0", "n // 8") + r""" AS w8 FROM b),
v AS (SELECT t, hx, n, w8, CASE WHEN n >= 32 THEN """ + _STRIPES + r""" END AS v FROM lanes),
h0 AS (SELECT t, hx, n, w8, """ + _add("CASE WHEN n >= 32 THEN " + _LONG + f" ELSE {(42 + 2870177450012600261) % 2 ** 64}::UHUGEINT END", "n::UHUGEINT") + r""" AS h FROM v),
h8 AS (SELECT t, hx, n, list_reduce(list_prepend(h, w8[4 * (n // 32) + 1:]), lambda a, x: """ + _add(_mul(_turn(_xor("a", _round("0::UHUGEINT", "x")), 27), _P1), _P4) + r""") AS h FROM h0),
h4 AS (SELECT t, hx, n, CASE WHEN n % 8 >= 4 THEN """ + _add(_mul(_turn(_xor("h", _mul("(" + _lanes(4, "n // 8 * 8", "1") + ")[1]", _P1)), 23), _P2), _P3) + r""" ELSE h END AS h FROM h8),
h1 AS (SELECT t, list_reduce(list_prepend(h, """ + _lanes(1, "n // 4 * 4", "n % 4") + r"""), lambda a, x: """ + _mul(_turn(_xor("a", _mul("x", _P5)), 11), _P1) + r""") AS h FROM h4),
hash AS (SELECT t, CAST(""" + _fold(_mul(_fold(_mul(_fold("h", 33), _P2), 29), _P3), 32) + r""" AS UBIGINT) AS h FROM h1),
bits AS (SELECT k, bit, count(*) AS n, sum((h >> bit::UBIGINT) & 1::UBIGINT) AS ones FROM sh JOIN hash USING (t), unnest(range(0, 64)) AS r(bit) GROUP BY k, bit),
made AS (SELECT k, bit_or(CASE WHEN 2 * ones > n THEN 1::UBIGINT << bit::UBIGINT ELSE 0::UBIGINT END) AS fp FROM bits GROUP BY k),
f AS (SELECT k, doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM d LEFT JOIN made USING (k)),
ids AS (SELECT fp, min(doc_id) AS low FROM f GROUP BY fp),
e AS (SELECT a.fp AS u, b.fp AS v FROM ids a, ids b WHERE bit_count(xor(a.fp, b.fp)) <= 3),
reach(u, v) AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON e.u = r.v)
SELECT doc_id, lower(lpad(hex(fp), 16, '0')) AS fingerprint, component_id FROM f JOIN (
  SELECT reach.u AS fp, min(low) AS component_id FROM reach JOIN ids ON ids.fp = reach.v GROUP BY reach.u) USING (fp)
"""

SQL = {"op5_simhash_dedup": OP5, "op7_quality_rules": OP7, "op11_conversation_repair": OP11, "op9_suffix_dedup": OP9, "op6_chat_format": OP6, "op2_url_filter": OP2, "op3_decontamination": OP3}
