"""Main text of web pages by tag-path ratios.

A page is read once as a stream of tags and text.  Block elements give text
nodes; a node's tag path is its chain of block ancestors, each with its class
words.  Per path:

* ``text`` ratio: characters of all nodes on the path divided by their number,
  link text taken off;
* ``punctuation`` ratio: punctuation marks divided by nodes;
* both are smoothed over page order with the neighbouring nodes' paths, fused by
  their geometric mean, and compared with a threshold set by their spread over
  the page.

Paths above it are content; the container that holds most content text is the
article, and its other blocks (headings, short paragraphs, lists, tables) go with it,
as with sibling elements that hold content.  Outside it a block stays if its path
passes the threshold by the ratio before smoothing, and a heading just before a kept
block does; outside an article element only the title (h1), or one in its main element.  Navigation, page headers, footers and asides are known by element and never
count.  Forms, roles, hidden parts and name words (class or id) are marks: a mark on
an element that holds most text of the page's article (of the page, if it has no
article element) is void; else forms, roles and hidden parts go, and a name lowers
the best path ratio of its element, which stays whole if that still passes.

The output keeps every content block whole: references decoded, white space
one space, blocks joined by a line feed.  Null or empty html gives an empty text.
Pages are independent rows: repeated rows, ties and very long pages need nothing
special; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Fixed values of HTML: element kinds.
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES_P = BLOCK - {"body", "html", "head", "caption", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# An open element of the key ends where one of the values starts, up to the scope.
ENDS_AT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
           "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
           "th": {"td", "th", "tr", "tbody", "thead", "tfoot"}}
SCOPE = {"ul", "ol", "dl", "table", "select", "menu", "article", "section", "div", "main", "body"}
# Elements, roles and class words of what is not the article.
AWAY_TAGS = {"script", "style", "noscript", "template", "svg", "canvas", "object", "nav", "aside", "footer",
             "form", "button", "select", "option", "textarea", "iframe", "title", "head", "dialog", "menu", "search",
             "fieldset", "label", "input", "noembed", "noframes", "xmp", "audio", "video"}
AWAY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert",
              "alertdialog", "form", "toolbar", "tablist"}
AWAY_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored",
              "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs",
              "sidebar", "aside", "widget", "footer", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent",
              "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup",
              "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
              "comments", "disqus", "reply", "replies", "respond", "pagination", "pager", "copyright", "hidden",
              "skip", "tags", "toc", "alert", "announcement", "paywall", "adsbygoogle"}
AWAY_STARTS = ("comment", "advert", "sponsor", "cookie", "breadcrumb", "sidebar", "navbar", "newsletter", "recommend")
# Away words that also name true parts of an article or its layout.
COMMON_WORDS = {"alert", "announcement", "aside", "banner", "consent", "copyright", "hidden", "login", "notice",
                "overlay", "promo", "promotion", "related", "recommended", "recommendations", "reply", "respond",
                "share", "sharing", "sidebar", "skip", "social", "subscription", "tags", "toc", "toolbar", "widget"}
COMMON_STARTS = ("sidebar", "recommend")
# What a name leaves of the ratio: a clear word, a common one alone, one in a compound ("related-work").
CLEAR, ALONE, COMPOUND = 0.1, 0.2, 0.5
MARK_TAGS = {"form", "fieldset"}           # they may also wrap a page
GONE_TAGS = AWAY_TAGS - MARK_TAGS
TEXT_TAGS = HEADINGS | {"p", "pre", "blockquote"}   # with inline elements: ids are anchors, compounds are topics
SKIP_LINK = {"skip-link", "skiplink", "skip-to-content"}
KEPT_WORDS = {"commentary", "commentator"}
HEAD_WORDS = {"header", "head"}            # only outside an article
TITLE_WORDS = {"article", "post", "entry", "story", "content"}   # "post-header" holds the title
LAYOUT = ("has", "with", "no", "without")  # "has-sidebar" speaks of the page, not of the part
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ARTICLE = {"article", "main"}
SECTIONS = ARTICLE | {"", "html", "body", "div", "section", "td", "center"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?…。、，！？；：]")


class Node:
    """A run of text in one block."""

    __slots__ = ("path", "parts", "linked", "chain")

    def __init__(self, path: str, chain: tuple):
        # A part is (text, in a link, numbers of the marks on it).
        self.path, self.chain, self.parts, self.linked = path, chain, [], 0

    def text(self) -> str:
        return _SPACE.sub(" ", unescape("".join(x[0] for x in self.parts))).strip()

    def drop(self, gone: set[int]) -> None:
        """Without the parts under the given marks."""
        self.parts = [x for x in self.parts if gone.isdisjoint(x[2])]
        self.linked = sum(len(x[0]) for x in self.parts if x[1])


def _attributes(s: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(s)} if s.strip(" /") else {}


def _name_share(tag: str, at: dict[str, str], in_article: bool) -> float:
    """What the class and id words of an element leave of its ratio."""
    share = 1.0
    text = tag in TEXT_TAGS or tag not in BLOCK
    for key in ("class",) if text else ("class", "id"):
        for token in at.get(key, "").split():
            found = [w.lower() for w in _WORDS.findall(token)]
            if not found or found[0] in LAYOUT:
                continue
            whole = len(found) == 1
            if text and not whole and token.lower() not in SKIP_LINK:
                continue
            for w in found:
                if w in AWAY_WORDS or (w.startswith(AWAY_STARTS) and w not in KEPT_WORDS):
                    common = w in COMMON_WORDS or w.startswith(COMMON_STARTS)
                    anchor = tag == "section" and key == "id"
                    share = min(share, COMPOUND if not whole and (common or anchor) else ALONE if common else CLEAR)
            if not in_article and not text and HEAD_WORDS.intersection(found) and not TITLE_WORDS.intersection(found):
                share = min(share, CLEAR)
    return share


def _mark(tag: str, at: dict[str, str], in_article: bool) -> tuple[float, bool]:
    """(share of the ratio left, shown) of an element; 0 for a form, a role or a hidden part."""
    if not at and tag not in MARK_TAGS or tag in ("html", "body"):
        return 1.0, True
    if "hidden" in at or at.get("aria-hidden") == "true" or HIDDEN.search(at.get("style", "")):
        return 0.0, False
    if tag in MARK_TAGS or at.get("role", "").lower() in AWAY_ROLES:
        return 0.0, True
    return (1.0 if tag in ARTICLE else _name_share(tag, at, in_article)), True


def text_nodes(html: str) -> tuple[list[Node], list[str], list[tuple[float, bool]], set[int]]:
    """Block text nodes in page order, without the parts that are known by element
    not to be the article; the tag of every element serial; the marks; and the
    serials of article elements with a name word."""
    tags = [""]
    marks: list[tuple[float, bool]] = []
    named: set[int] = set()
    # (tag, path, serial, away, marks); block, away and marked elements open a level, and all in an inline one.
    stack = [("", "", 0, False, ())]
    nodes: list[Node] = []
    node = None
    serial = links = article = 0
    pos, n = 0, len(html)

    def put(s: str) -> None:
        nonlocal node
        if stack[-1][3] or not s:
            return
        if node is None:
            if s.isspace():
                return
            node = Node(stack[-1][1], tuple(x[2] for x in stack if x[0] in BLOCK or not x[0]))
            nodes.append(node)
        node.parts.append((s, links > 0, stack[-1][4]))
        if links:
            node.linked += len(s)

    def close_to(depth: int) -> None:
        nonlocal article, node
        while len(stack) > depth:
            tag = stack.pop()[0]
            article -= tag in ARTICLE
            if tag in BLOCK:
                node = None

    def find(tags, stop=frozenset()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                return 0
        return 0

    while pos < n:
        m = _TOKEN.search(html, pos)
        if m is None:
            # A tag that the page's end cuts off is markup, not text.
            cut = html.rfind("<", pos)
            tail = html[pos:] if cut < 0 or not re.match(r"</?[a-zA-Z!]", html[cut:cut + 3]) else html[pos:cut]
            put(tail)
            break
        put(html[pos:m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                put(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag == "br":
                put(" ")
            elif tag in BLOCK or tag in AWAY_TAGS:
                at = find({tag})
                if at:
                    close_to(at)
            else:
                # Inline: on the stack only as, or in, an away or marked part.
                at = find({tag}, BLOCK)
                if at:
                    close_to(at)
            continue
        if tag in VOID:
            if tag == "br":
                put(" ")
            elif tag == "hr":
                node = None
            continue
        at = _attributes(m[3])
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, pos)
            pos = end.end() if end else n
            continue
        if tag == "a":
            links = 1
        away = stack[-1][3] or tag in GONE_TAGS or (tag == "header" and not article)
        mark = (1.0, True) if away else _mark(tag, at, article > 0)
        if tag in CLOSES_P:
            p = find({"p"}, SCOPE)
            if p:
                close_to(p)
        for open_tag, starts in ENDS_AT.items():
            if tag in starts:
                i = find({open_tag}, SCOPE - {open_tag})
                if i:
                    close_to(i)
        top = stack[-1]
        if tag in BLOCK or away or mark[0] < 1 or (top[0] and top[0] not in BLOCK):
            if m[3].rstrip().endswith("/") and tag not in BLOCK:
                continue
            on = top[4]
            if mark[0] < 1:
                on = (*on, len(marks))
                marks.append(mark)
            if tag not in BLOCK:
                stack.append((tag, top[1], top[2], away, on))
                continue
            serial += 1
            tags.append(tag)
            if tag in ARTICLE and _name_share(tag, at, True) < 1:
                named.add(serial)
            name = f"{tag}.{at['class'].split()[0]}" if at.get("class", "").split() else tag
            stack.append((tag, f"{top[1]}/{name}", serial, away, on))
            article += tag in ARTICLE
            node = None
    return nodes, tags, marks, named


def _fused(chars, marks):
    return np.sqrt((1 + chars) * (1 + marks)) - 1


def _passes_outside(nodes: list[Node], mark: int, region: int | None) -> bool:
    """Whether unmarked text beside a mark reaches the path ratio of the mark's own."""
    best = [0.0, 0.0]
    ratio = defaultdict(lambda: [0, 0, 0])
    for x in nodes:
        if region is not None and region not in x.chain:
            continue
        for side, kept in ((0, [p[0] for p in x.parts if mark in p[2] and not p[1]]),
                           (1, [p[0] for p in x.parts if not p[2] and not p[1]])):
            if kept:
                r = ratio[side, x.path]
                r[0] += sum(len(s.strip()) for s in kept)
                r[1] += len(_PUNCT.findall(unescape("".join(kept))))
                r[2] += 1
    for (side, _), (c, m, n) in ratio.items():
        best[side] = max(best[side], float(_fused(c / n, m / n)))
    # Without a known article a tagline beside a form around the page must not count.
    return best[1] > 0 and best[1] >= (0.5 if region is None else 0.15) * best[0]


def away_marks(nodes: list[Node], tags: list[str], marks: list[tuple[float, bool]], named: set[int]) -> set[int]:
    """The marks whose parts are not the article."""
    if not marks:
        return set()
    # Text outside links, by part: (characters, chain, marks, shown, without a clear name).
    parts = []
    for x in nodes:
        for s, linked, on in x.parts:
            if not linked:
                parts.append((len(s) - s.count(" ") - s.count("\n"), x.chain, on, all(marks[i][1] for i in on),
                              all(marks[i][0] > CLEAR for i in on)))
    for seen in ([p for p in parts if p[3] and p[4]], [p for p in parts if p[3]], parts):
        if sum(p[0] for p in seen):
            break
    # The article element: the largest that holds a quarter of the text, or the main element that does.
    held = defaultdict(int)
    for n, chain, *_ in seen:
        for serial in chain:
            if tags[serial] in ARTICLE and serial not in named:
                held[serial] += n
    least = 0.25 * sum(p[0] for p in seen)
    region = None
    for tag in ("article", "main"):
        found = [(n, -serial) for serial, n in held.items() if tags[serial] == tag and n >= least]
        if found and region is None:
            region = -max(found)[1]
    shown = [p for p in parts if p[3]] if any(p[3] and p[0] for p in parts) else parts
    whole, inside, within = 0, defaultdict(int), set()
    for n, chain, on, *_ in shown:
        if region is None or region in chain:
            whole += n
            for i in on:
                inside[i] += n
                within.add(i)
    void = {i for i, n in inside.items() if 2 * n > whole
            and (marks[i][0] > CLEAR or not _passes_outside(nodes, i, region))}
    # Outside a known article a name says more.
    share = {i: v if region is None or i in within else 0.0 if v <= CLEAR else 0.1 * v
             for i, (v, _) in enumerate(marks) if i not in void}
    gone = {i for i, v in share.items() if v == 0}
    if len(gone) == len(share):
        return gone
    # Path ratios: of what is not under a mark, and of every mark's own parts.
    ratio = {}
    for x in nodes:
        by_mark = defaultdict(list)
        for p in x.parts:
            for i in [j for j in p[2] if j not in void] or [None]:
                by_mark[i].append(p)
        for i, kept in by_mark.items():
            t = "".join(p[0] for p in kept)
            r = ratio.setdefault((i, x.path), [0, 0, 0])
            r[0] += sum(len(p[0].strip()) for p in kept if not p[1])
            r[1] += len(_PUNCT.findall(unescape(t)))
            r[2] += 1
    best = defaultdict(float)
    for (i, _), (c, m, n) in ratio.items():
        best[i] = max(best[i], float(_fused(c / n, m / n)))
    # One long run does not outweigh a clear name.
    return gone | {i for i, v in share.items() if v * min(best[i], 2 * best[None]) < 0.25 * best[None]}


def path_scores(nodes: list[Node], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fused tag-path ratio of every node: smoothed, and its path's own."""
    chars, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for node, t in zip(nodes, texts):
        chars[node.path] += max(len(t) - node.linked, 0)
        marks[node.path] += len(_PUNCT.findall(t))
        count[node.path] += 1
    ratio = np.array([[chars[x.path] / count[x.path], marks[x.path] / count[x.path]] for x in nodes])
    pad = np.pad(ratio, ((1, 1), (0, 0)), mode="edge")
    smooth = 0.25 * pad[:-2] + 0.5 * pad[1:-1] + 0.25 * pad[2:]
    return _fused(smooth[:, 0], smooth[:, 1]), _fused(ratio[:, 0], ratio[:, 1])


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    nodes, tags, marks, named = text_nodes(html)
    gone = away_marks(nodes, tags, marks, named)
    if gone:
        for x in nodes:
            x.drop(gone)
    texts = [x.text() for x in nodes]
    both = [(x, t) for x, t in zip(nodes, texts) if t]
    if not both:
        return ""
    nodes, texts = map(list, zip(*both))
    score, own = path_scores(nodes, texts)
    content = score >= max(score.max() * 0.25, score.mean() - score.std())
    passed = own >= max(own.max() * 0.25, own.mean() - own.std())
    depth, inside, siblings = _container(nodes, texts, content, passed, tags)
    text = [x.linked < 0.8 * len(t) for x, t in zip(nodes, texts)]
    # No element sets the article apart: blocks of nothing but links go.
    loose = tags[inside] in ("", "html", "body")
    part = [len(x.chain) > depth and x.chain[depth] in siblings for x in nodes]
    keep = [(k or not loose) if p else k and bool(c) and tags[x.chain[-1]] not in HEADINGS
            for x, p, k, c in zip(nodes, part, text, passed)]
    _headings(nodes, tags, keep, [x for x in nodes[part.index(True)].chain if tags[x] in ARTICLE])
    return "\n".join(t for t, k in zip(texts, keep) if k)


def _headings(nodes: list[Node], tags: list[str], keep: list[bool], around: list[int]) -> None:
    """Marks the headings just before a kept node as kept.  ``around``: the article
    elements about the container, from the outermost."""
    for i in range(len(nodes) - 2, -1, -1):
        tag = tags[nodes[i].chain[-1]]
        if not keep[i] and keep[i + 1] and tag in HEADINGS:
            keep[i] = tag == "h1" or not around or around[0] in nodes[i].chain


def _container(nodes: list[Node], texts: list[str], content: np.ndarray, passed: np.ndarray,
               tags: list[str]) -> tuple[int, int, set[int]]:
    """(depth, serial) of the article: the deepest section that holds most
    content text, widened to the article element around it or, outside the
    body itself, to sections that add little; and the serials of it and of its
    sibling elements of the same tag with content of their own."""
    picked, whole, paths = defaultdict(int), defaultdict(int), defaultdict(set)
    for x, t, c in zip(nodes, texts, content):
        for depth, serial in enumerate(x.chain):
            whole[depth, serial] += len(t)
            picked[depth, serial] += len(t) * bool(c)
            if depth + 1 < len(x.chain):
                paths[depth, serial].add(x.chain[depth + 1])
    total = picked[0, 0]
    # One of several like blocks is a paragraph, not the article.
    ok = [k for k, v in picked.items() if v >= 0.8 * total and tags[k[1]] in SECTIONS and (len(paths[k]) or k[0] == 0)]
    depth, serial = max(ok)
    chain = next(x.chain for x in nodes if len(x.chain) > depth and x.chain[depth] == serial)
    around = [d for d in range(depth + 1) if tags[chain[d]] in ARTICLE]
    if around:
        depth = around[-1]
    else:
        while depth > 1 and tags[chain[depth]] != "td" and tags[chain[depth - 1]] not in ("body", "html", "") \
                and whole[depth - 1, chain[depth - 1]] <= 1.25 * total:
            depth -= 1
    siblings = {x.chain[depth] for x, t, c in zip(nodes, texts, passed) if c and x.linked < 0.8 * len(t)
                and len(x.chain) > depth and x.chain[:depth] == chain[:depth]
                and tags[x.chain[depth]] == tags[chain[depth]]}
    return depth, chain[depth], siblings | {chain[depth]}


def _run(batches):
    for b in batches:
        texts = [extract(h) for h in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [*b.schema.names[:-1], "text", "n_chars"])


def extract_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``; columns already
    named like these are replaced."""
    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(*rest, html_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_run, f"{fields}{', ' if rest else ''}text string, n_chars long")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
