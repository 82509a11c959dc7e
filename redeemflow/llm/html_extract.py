"""Main text of a web page by two-pass block rules.

The page is cut into text blocks at block-level tags.  First pass: a block's
link density, length, stop-word density and surroundings make it good, bad or
undecided.  Second pass: undecided blocks (short ones, and long ones with few
stop words) inherit the label of the nearest decided neighbours; the edges of an
``article`` or ``main`` element count as good neighbours of what they hold.  On a
page without a good block and without such an element, as in a language the stop
words do not know, long blocks of running text are good.

Boilerplate is told by element, or by a word in any block element's class, id, role or
label.  A boilerplate element without an end tag of its own ends at the next block tag,
and one that wraps the page says nothing about what it holds: a form round everything, or
a holder named for its layout (``has-sidebar``) on a page without running text elsewhere.
A heading in an article's own header is the article's.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: frequent words of the four languages of the corpus (fixed values)
STOP_WORDS = frozenset("""
the of and to in is was for that it with on as are be this by at or from an not but
de la le les et des un une du en que qui dans pour sur pas au avec est il ce par plus ne
der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an aus
de la que el en y a los se del las un por con no una su para es al lo como
""".split())

#: an undecided block's limits: shorter ones, or with fewer stop words, are not decided alone
SHORT, STOP_LOW, LINK_HIGH = 70, 0.2, 0.35

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<svg(?=[\s/])(?>[^<>"']+|"[^"]*"|'[^']*')*(?<=/)>"""
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^<>"']+|"[^"]*"|'[^']*')*)>"""
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>", re.S | re.I)
_INLINE = frozenset("a abbr b bdi bdo cite code del dfn em font i img ins kbd label mark q s samp small span "
                    "strike strong sub sup time tt u var wbr".split())
_BAD_TAGS = frozenset("nav header footer aside form button menu dialog head".split())
_GOOD_TAGS = frozenset("article main".split())
_FIELD_TAGS = frozenset("label legend".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_HOLDERS = frozenset("div section ul ol dl table td".split()) | _BAD_TAGS | _GOOD_TAGS
#: holders that a name alone makes boilerplate
_NAMED = frozenset("div section ul ol dl table td".split())
_NAME = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|consent|contentinfo|cookies?|footer|gdpr|"
    r"disqus|header|masthead|menu|modal|nav(?:bar|igation)?|newsletter|notices?|alert|popup|promo\w*|related|respond|search|"
    r"share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?=$|[\s_-])", re.I)
_WORD = re.compile(r"[^\s_-]+")
#: how running text ends, in any script that marks it
_SENTENCE = re.compile("[.!?\u2026\u3002\uff01\uff1f\u0964\u061f\u06d4\u104b\u17d4][\"'\xbb\u201d\u2019)\\]]*$")


def _names(attributes: str) -> str:
    """Class, id, role and label of a start tag, camel case taken apart."""
    return _CAMEL.sub("-", " ".join(filter(None, (g for x in _NAME.findall(attributes) for g in x))))


class _Open:
    """Elements that are open: (tag, value) from the outermost.  Block elements that are no
    holders are kept while one of their tag and a boilerplate name is open."""

    def __init__(self):
        self.items, self.tags = [], Counter()

    def holds(self, tag: str, named: bool) -> bool:
        return tag in _HOLDERS or tag in _FIELD_TAGS or named or self.tags[tag] > 0

    def push(self, tag, value):
        self.items.append((tag, value))
        self.tags[tag] += 1

    def pop(self, tag):
        """The value of the innermost element of that tag, which ends it and those inside."""
        if not self.tags[tag]:
            return None
        while True:
            last, value = self.items.pop()
            self.tags[last] -= 1
            if last == tag:
                return value

    def drop(self, tag):
        self.items = [x for x in self.items if x[0] != tag]
        self.tags[tag] = 0


class _Shape:
    """What a page looks like before its blocks are judged: which start tags (by place in
    ``tokens``) have an end tag of their own, with the characters and articles between
    both; characters and articles of the page; and the holders named for their layout that
    say nothing, because the page has no running text outside boilerplate."""

    def __init__(self, page: str, tokens):
        self.closed: dict[int, tuple[int, int]] = {}
        self.chars = self.articles = 0
        self.names: dict[int, str] = {}
        stack, at, clear, bad = _Open(), 0, 0, 0  # clear: running text outside boilerplate
        outer: list[tuple[int, int]] = []
        for k, m in enumerate(tokens):
            n = len(page[at:m.start()].strip())
            self.chars += n
            clear += n if n >= SHORT and not bad else 0
            at = m.end()
            tag = (m[3] or "").lower()
            if tag == "body" and not m[2]:
                stack.drop("head")
                bad = sum(v[3] for _, v in stack.items)
            if not tag or tag in _INLINE and tag not in _FIELD_TAGS or tag in ("br", "hr"):
                continue
            if m[2]:
                value = stack.pop(tag)
                if value:
                    start, c, a, is_bad, bad = value
                    self.closed[start] = (self.chars - c, self.articles - a)
                    if is_bad and not bad and tag in _NAMED:
                        outer.append((self.chars - c, start))
            elif not m[4].endswith("/"):
                names = _names(m[4])
                named = bool(_BAD_NAME.search(names))
                if not stack.holds(tag, named):
                    continue
                if named:
                    self.names[k] = names
                is_bad = named or tag in _BAD_TAGS
                stack.push(tag, (k, self.chars, self.articles, is_bad, bad))
                bad += is_bad
                self.articles += tag in _GOOD_TAGS
        n = len(page[at:].strip())
        self.chars += n
        clear += n if n >= SHORT and not bad else 0
        self.neutral = {k for c, k in outer if not clear and 2 * c > self.chars and self._layout(self.names.get(k, ""))}

    @staticmethod
    def _layout(names: str) -> bool:
        """Whether a name has another word than boilerplate's."""
        return any(not _BAD_NAME.search(w) for w in _WORD.findall(names))

    def wraps(self, k: int, tag: str) -> bool:
        if k in self.neutral:
            return True
        c, a = self.closed[k]
        most, form = 2 * c > self.chars, tag == "form"
        return form and most or bool(a) and a == self.articles and (form or most)


def blocks_of(page: str):
    """``(text, link characters, inside, region, tag)`` per block; ``inside`` is -1 in a
    boilerplate element, -2 in an article's header, 1 in an article, else 0; ``region``
    numbers the articles; ``tag`` is the block tag opened last, empty after a closed one."""
    blocks, parts, link_chars, in_link, block_tag = [], [], 0, 0, ""
    stack = _Open()
    regions = 0
    tokens = list(_TOKEN.finditer(page))
    shape = _Shape(page, tokens)
    unclosed = False  # the element opened last is boilerplate without an end tag

    def where():
        return stack.items[-1][1] if stack.items else (0, 0)

    def close():
        nonlocal parts, link_chars
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                blocks.append((text, link_chars, *where(), block_tag))
        parts, link_chars = [], 0

    def add(raw):
        nonlocal link_chars
        if raw:
            text = _html.unescape(raw)
            parts.append(text)
            if in_link:
                link_chars += len(text.strip())

    at = 0
    for k, m in enumerate(tokens):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        field = tag in _FIELD_TAGS and stack.tags["form"] > 0
        if tag in ("br", "hr"):
            parts.append(" ")
        elif tag in _INLINE and not field:
            if tag == "a":
                in_link = 0 if m[2] else 1
        else:
            close()
            in_link, block_tag = 0, "" if m[2] else tag
            if unclosed:
                stack.items[-1] = (stack.items[-1][0], stack.items[-2][1] if len(stack.items) > 1 else (0, 0))
                unclosed = False
            if tag == "body" and not m[2]:
                stack.drop("head")
            if m[2]:
                stack.pop(tag)
            elif not m[4].endswith("/") and (field or tag not in _FIELD_TAGS and stack.holds(tag, k in shape.names)):
                inside, region = where()
                if (tag in _BAD_TAGS or field or k in shape.names) and not (k in shape.closed and shape.wraps(k, tag)):
                    inside = -2 if tag == "header" and inside == 1 and k in shape.closed else -1
                    unclosed = k not in shape.closed
                elif tag in _GOOD_TAGS and inside >= 0:
                    if not region:
                        regions += 1
                        region = regions
                    inside = 1
                stack.push(tag, (inside, region))
    add(page[at:])
    close()
    return blocks


def decide(text: str, link_chars: int, inside: int, tag: str) -> int:
    """First pass: 1 good, -1 bad, 0 undecided.  In an article, a heading or sentence
    that is a link is undecided; a list item that is one is a menu's."""
    if inside < 0:
        return 1 if inside == -2 and tag in _HEADINGS else -1
    if link_chars > LINK_HIGH * len(text):
        return 0 if inside and tag != "li" else -1
    if len(text) < SHORT:
        return -1 if not inside and ("\xa9" in text or link_chars) else 0
    words = text.lower().split()
    stop = sum(w.strip(".,;:!?") in STOP_WORDS for w in words) / len(words)
    return 1 if stop >= STOP_LOW else 0


def _running(text: str) -> bool:
    """Long running text, whatever its language: it ends like a sentence, or is in a
    script that hardly uses spaces."""
    if len(text.encode("utf-8", "replace")) < 2 * SHORT or "\xa9" in text:
        return False
    return bool(_SENTENCE.search(text)) or not text.isascii() and len(text) > 12 * len(text.split())


def main_text(page: str | None) -> str:
    """Good blocks in page order, joined by line feeds."""
    blocks = blocks_of(page or "")
    labels = [decide(text, links, inside, tag) for text, links, inside, _, tag in blocks]
    if not any(x > 0 for x in labels) and not any(b[3] for b in blocks):
        labels = [1 if not x and _running(b[0]) else x for b, x in zip(blocks, labels)]
    if not any(x > 0 for x in labels) and not any(b[3] for b in blocks):  # a page of short paragraphs
        labels = [1 if not x and not b[1] and _SENTENCE.search(b[0]) and "\xa9" not in b[0] else x
                  for b, x in zip(blocks, labels)]
    near = [_neighbours(blocks, labels, range(len(blocks))),
            _neighbours(blocks, labels, range(len(blocks) - 1, -1, -1))]
    kept = []
    for block, label, (d0, before), (d1, after) in zip(blocks, labels, *near):
        if not label:
            if block[4] in _HEADINGS:  # a heading goes with what follows
                label = after
            else:
                label = before if d0 < d1 else after if d1 < d0 else min(before, after)
        if label > 0:
            kept.append(block[0])
    return "\n".join(kept)


def _neighbours(blocks, labels, order) -> list[tuple[int, int]]:
    """Distance and label of the nearest decided block met before, in ``order``.

    The page's edge is bad.  Inside an article its edge is good, and bad blocks
    are passed over: they say nothing about the article around them.
    """
    found: list = [None] * len(blocks)
    label, region, far = -1, 0, 0
    for i in order:
        far += 1
        if blocks[i][3] != region:
            region = blocks[i][3]
            if region:
                label, far = 1, 1
        found[i] = (far, label)
        if labels[i] > 0 or labels[i] < 0 and not region:
            label, far = labels[i], 0
    return found


def _extract(batches):
    for b in batches:
        text = [main_text(h.as_py()) for h in b.column("html")]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
             pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Defined cases: null or empty html, and pages of boilerplate alone, give an
    empty text; nothing is capped; repeated rows are kept; unclosed boilerplate
    elements end at the next block tag, comments and quotes at the next tag or the
    page's end; other columns are ignored.
    """
    return (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
