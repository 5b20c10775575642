"""Main text of web pages: block structure plus a suffix array over each host's pages.

Pages are grouped by host; a host with many pages is cut into groups of about
``GROUP_PAGES`` by a hash, so a hot host becomes many tasks. In a group the pages' token
streams (words and block tags) are concatenated, every page closed by a token of its own,
and suffixes are sorted by prefix doubling until prefixes of ``REPEAT`` tokens are ranked.
Suffixes of equal rank share a substring of that length; if they stand on enough distinct
pages, the tokens under it are boilerplate. A longer repeat is covered by its windows of
that length, so the depth loses nothing.

A block is dropped if it lies in page furniture (menus, headers, footers, sidebars,
forms, adverts, notices, comments, by element or by class, id or role). A class or id counts
only if it is such a name as a whole (``comments-section``, ``site-header``; not ``related-work`` or
``entry-header``), inside an article or main element only if it is one anywhere, and never as the id of a
heading; an element around an article is not furniture because of a name. On a page with an
article or main element the blocks inside it are the text, but for those under substrings that
``ARTICLE_SHARE`` of the group's pages have (subscribe lines, share prompts); passages that fewer
articles share are theirs and stay, and an article that would lose most of its words is a copy and
stays whole. On other pages the blocks that boilerplate covers are dropped and the
unique runs stay.

Cases: null or empty html gives an empty text; a null url is a host of its own; rows that
repeat a page_id are extracted each for itself; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quench.llm.common import col, text_of

GROUP_PAGES = 200
#: Hosts with more pages than a group that may be broadcast (a name and a count each).
BROADCAST_HOSTS = 500_000
REPEAT = 8
LEAST_PAGES, LEAST_SHARE = 3, 0.5
#: Inside an article only what nearly every page of the host has is boilerplate: articles share passages too.
ARTICLE_PAGES, ARTICLE_SHARE = 10, 0.8
COVERED = 0.8

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|svg|iframe|select|object)\b[^>]*>(?:.*?</\1\s*>|.*\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|[^<]+|<", re.S | re.I)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "dfn", "em", "font", "i", "img", "ins", "del",
           "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var", "wbr"}
_FURNITURE = {"nav", "footer", "aside", "form", "head", "menu", "button", "dialog"}
_CONTENT = {"article", "main"}
_OPTIONAL_END = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}


#: Words that name furniture anywhere, outside an article too, and what may follow them in a name (``comments-section``).
_CLEAR = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "nav", "navbar", "navigation", "sidebar", "breadcrumb",
          "breadcrumbs", "comment", "comments", "disqus", "related", "share", "sharing", "social", "subscribe", "newsletter", "popup", "modal",
          "pagination", "cookie", "cookies", "consent", "respond", "replies"}
_OUTSIDE = {"header", "footer", "masthead", "menu", "banner", "notice", "notices", "search", "widget", "widgets", "contentinfo", "complementary"}
_PARTS = {"area", "articles", "bar", "block", "box", "buttons", "container", "form", "icons", "inner", "items", "link", "links", "list", "outer", "panel",
          "posts", "section", "signup", "slot", "thread", "top", "bottom", "wrap", "wrapper", "banner", "notice", "widget", "menu", "message", "overlay"}
_PLACES = {"site", "page", "main", "top", "bottom", "global", "left", "right", "mobile", "primary", "secondary"}
#: Names that end in these are furniture whatever comes before, but for ``no-sidebar`` and the like.
_LAST = {"ads", "advert", "adverts", "breadcrumbs", "comments", "navbar", "navigation", "newsletter", "pagination", "sidebar"}
_FLAGS = {"no", "has", "with", "without", "hide", "show"}
_CLEAR_ROLES = {"navigation", "complementary", "contentinfo", "search"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NONE, _LOOSE, _CLEARLY, _BY_TAG = range(4)


def _names_furniture(name: str, outside: bool) -> bool:
    """Whether a class token or id is a name of furniture as a whole; a word inside a longer name is not enough."""
    parts = [p for p in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if p]
    if not parts or parts[0] in _FLAGS:
        return False
    words = _CLEAR | _OUTSIDE if outside else _CLEAR
    if outside and len(parts) > 1 and parts[0] in _PLACES:
        parts = parts[1:]
    return parts[-1] in _LAST or (parts[0] in words and all(p in words or p in _PARTS for p in parts[1:]))


def _kind(tag: str, attributes: str, in_content: bool) -> int:
    """How surely an element is furniture: by its tag, by a name that is one anywhere, by one that is outside articles, or not."""
    if tag == "form":
        return _LOOSE
    if tag in _FURNITURE or (tag == "header" and not in_content):
        return _BY_TAG
    if tag in ("html", "body") or tag in _CONTENT:
        return _NONE
    kind = _NONE
    for attribute, *values in _ATTRIBUTE.findall(attributes):
        names, attribute = "".join(values).split(), attribute.lower()
        if tag in _INLINE:
            names = [n for n in names if n.lower() != "comment"]  # a piece of code, not a reader's comment
        if tag in _HEADINGS and attribute == "id":
            continue  # an anchor
        if attribute == "role":
            clear = not _CLEAR_ROLES.isdisjoint(n.lower() for n in names)
        else:
            clear = any(_names_furniture(n, False) for n in names)
        if clear:
            return _CLEARLY
        if not in_content and any(_names_furniture(n, True) for n in names):
            kind = _LOOSE
    return kind


class _Element:
    """An open element; ``holds`` counts the article and main elements in it."""

    __slots__ = ("name", "kind", "content", "parent", "holds", "main", "furniture")

    def __init__(self, name: str, kind: int, parent: _Element | None):
        self.name, self.kind, self.parent, self.holds, self.main, self.furniture = name, kind, parent, 0, False, None
        self.content = name in _CONTENT or (parent is not None and parent.content)
        if name in _CONTENT:
            up = parent
            while up is not None:
                up.holds, up.main = up.holds + 1, up.main or name == "main"
                up = up.parent

    def within(self, total: int) -> bool:
        """Whether it or an element around it is furniture. A wrapper of an article or main element is none by a word in
        its names, and by a clear name only if the page has others (``total`` in all) and it holds no main element."""
        chain, at = [], self
        while at is not None and at.furniture is None:  # pages may nest without end: no recursion
            chain.append(at)
            at = at.parent
        around = at is not None and at.furniture
        for e in reversed(chain):
            around = e.furniture = (around or e.kind == _BY_TAG or (e.kind == _LOOSE and not e.holds)
                                    or (e.kind == _CLEARLY and not e.main and (not e.holds or e.holds < total)))
        return self.furniture


def parse(page: str) -> list[tuple[str, str, bool, bool]]:
    """(tag, text, furniture, content) of a page's blocks in order; text is decoded and its white space collapsed."""
    blocks: list[tuple[str, str, _Element]] = []
    root = _Element("", _NONE, None)
    stack: list[_Element] = []
    opened: Counter[str] = Counter()  # names on the stack
    run: list[str] = []
    tag_of = "body"

    def flush():
        text = " ".join(_html.unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append((tag_of, text, stack[-1] if stack else root))

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    for m in _TOKEN.finditer(page):
        name = m.group(3)
        if name is None:
            whole = m.group()
            if whole[0] != "<" or whole == "<":
                run.append(whole)
            continue
        name, closing = name.lower(), m.group(2) == "/"
        parent = stack[-1] if stack else root
        if name in _INLINE and (closing or name in _VOID or not _kind(name, m.group(4), parent.content)):
            if name == "br":
                run.append(" ")
            elif closing and opened[name]:  # an inline element that was opened as furniture
                flush()
                while pop() != name:
                    pass
            continue
        flush()
        if closing:
            if opened[name]:
                while pop() != name:
                    pass
            tag_of = stack[-1].name if stack else "body"
        else:
            if name in _OPTIONAL_END and stack and stack[-1].name == name:
                pop()
                parent = stack[-1] if stack else root
            tag_of = name
            if name not in _VOID and not m.group(4).endswith("/"):
                stack.append(_Element(name, _kind(name, m.group(4), parent.content), parent))
                opened[name] += 1
    flush()
    return [(tag, text, e.within(root.holds), e.content) for tag, text, e in blocks]


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``depth`` tokens or more, by prefix doubling (equal prefixes share a rank)."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length, n = 1, len(tokens)
    while length < depth:
        step = min(length, depth - length)
        after = np.full(n, -1, np.int64)
        after[:max(0, n - step)] = rank[step:]
        rank = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        length += step
    return rank


def boilerplate(streams: list[list[int]], levels: list[tuple[int, float]], repeat: int = REPEAT) -> list[list[np.ndarray]]:
    """For each (pages, share) level and page's stream, which tokens lie under a substring of ``repeat`` tokens that is on enough distinct pages."""
    lengths = np.array([len(s) + 1 for s in streams])
    top = max((max(s, default=0) for s in streams), default=0) + 1
    tokens = np.concatenate([np.array([*s, top + i], np.int64) for i, s in enumerate(streams)])  # each page ends in a token of its own
    page = np.repeat(np.arange(len(streams)), lengths)
    rank = suffix_ranks(tokens, repeat)
    seen = np.unique(rank * len(streams) + page) // len(streams)  # one entry a (prefix, page)
    pages = np.bincount(seen, minlength=rank.max() + 1)
    out = []
    for least_pages, least_share in levels:
        start = np.flatnonzero(pages[rank] >= max(least_pages, least_share * len(streams)))
        edge = np.zeros(len(tokens) + repeat + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + repeat, -1)
        covered = np.cumsum(edge)[:len(tokens)] > 0
        out.append([c[:-1] for c in np.split(covered, np.cumsum(lengths)[:-1])])
    return out


def extract_group(pages: list[str]) -> list[str]:
    """The main texts of one group's pages."""
    parsed = [parse(p) for p in pages]
    number: dict[str, int] = {}
    streams, spans = [], []
    for blocks in parsed:
        stream: list[int] = []
        span = []
        for tag, text, _, _ in blocks:
            stream.append(number.setdefault(f"<{tag}>", len(number)))
            at = len(stream)
            stream.extend([number.setdefault(w, len(number)) for w in text.split(" ")])
            span.append((at, len(stream)))
        streams.append(stream)
        spans.append(span)
    out = []
    for blocks, span, cover, wide in zip(parsed, spans, *boilerplate(streams, [(LEAST_PAGES, LEAST_SHARE), (ARTICLE_PAGES, ARTICLE_SHARE)])):
        article = any(content and not furniture for _, _, furniture, content in blocks)
        kept = [(text, s, e) for (_, text, furniture, content), (s, e) in zip(blocks, span) if not furniture and (content or not article)]
        unique = [(text, s, e) for text, s, e in kept if (wide if article else cover)[s:e].mean() < COVERED]
        if article and 2 * sum(e - s for _, s, e in unique) < sum(e - s for _, s, e in kept):
            unique = kept  # a copy of another page's article
        out.append("\n".join(text for text, _, _ in unique))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group_pages: int = GROUP_PAGES) -> DataFrame:
    """``id, url, text``: one row per page."""
    rows = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), text_of(html_col).alias("html"))
    rows = rows.withColumn("host", F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit("")))
    hot = (rows.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / group_pages).alias("cuts")).filter("cuts > 1"))
    if hot.count() <= BROADCAST_HOSTS:
        hot = F.broadcast(hot)
    rows = (rows.join(hot, "host", "left")
            .withColumn("part", F.pmod(F.xxhash64("id", "html"), F.coalesce("cuts", F.lit(1).cast("long")))).drop("cuts"))

    def run(group: pa.Table) -> pa.Table:
        return pa.table({"id": group.column("id"), "url": group.column("url"), "text": pa.array(extract_group(group.column("html").to_pylist()), pa.string())})

    schema = T.StructType([*rows.select("id", "url").schema.fields, T.StructField("text", T.StringType())])
    return rows.groupBy("host", "part").applyInArrow(run, schema)
