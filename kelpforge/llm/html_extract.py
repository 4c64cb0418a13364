"""Main text of web pages by composite text density.

Every page is parsed into a tree (implied end tags, void and raw-text elements are handled as
in HTML). For each element the composite text density of Sun, Song and Liao (2011) is taken:
characters per tag, adjusted by the share of characters and tags in links. The density sum of
an element is the sum over its children (text of its own counts as one child). Within the
body, without elements whose tag, role, class or id names them as page furniture, the element
of the largest density sum is the core. The threshold is the least density on the path from
the body to the core; siblings along this path that are as dense as that belong to the main
text too. A core inside an ``article`` or ``main`` element is widened to it.

Text: character references decoded, white space inside a block taken as one space, blocks
joined in page order by one space.

A form is furniture unless it holds most of the page's text. Where no name marks the furniture,
the densities alone tell an article from lists of links.

Defined cases: null html counts as empty; a page without text gives an empty string; a page
that is furniture throughout falls back to all its visible text; repeated rows and null ids
give a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import chunks, map_arrow

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+(?=>|\Z)|[^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements of HTML by their role in parsing and layout.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe textarea title svg select object canvas audio video annotation annotation-xml".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img "
    "math mrow mi mo mn ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mtable mtr mtd semantics".split()
)
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: An opening tag ends an open element of the second set, unless one of the third is met first.
_IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_P_SCOPE = frozenset("table td th caption button object html body".split())
#: Names of page furniture, as tags, roles, and words of classes and ids.
_FURNITURE_TAGS = frozenset("nav header footer aside form dialog button head".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_FURNITURE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside ad ads adv advert adverts advertisement advertising banner promo promoted sponsor sponsored "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations "
    "comment comments commentlist disqus replies reply respond footer header masthead toolbar pagination pager widget login signin signup search skip".split()
)
#: Words that say how a named part is laid out, not what it is.
_LAYOUT_NAMES = frozenset(
    "area bar bars block body bottom box boxes btn button buttons card cards col column container content cta form group grid head heading icon icons inner item items left "
    "link links list main media message module outer page panel post posts right row section site slot story stories text thread title top unit wide wrap wrapper".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_NEGATIONS = frozenset("no not with without has have non".split())
_CONTAINERS = frozenset("article main".split())


def _furniture(tag: str, attrs: str, inside: bool) -> bool:
    """Whether an element is furniture by its names.

    Inside an article names are a weaker hint: a header or heading stays, and a class or id
    counts only if all its words name furniture or layout ("share-buttons", not "social-history").
    """
    if tag in _FURNITURE_TAGS and not (tag == "header" and inside):
        return True
    if not attrs or attrs.isspace():
        return False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if name == "role" and value.strip().lower() in _FURNITURE_ROLES:
            return True
        if name in ("class", "id") and tag not in ("body", "html", "main") and not (inside and tag in _HEADINGS):
            for word in value.split():
                parts = [x.lower() for x in _NAME.findall(word)]
                named = [p in _FURNITURE_NAMES and not (k and parts[k - 1] in _NEGATIONS) for k, p in enumerate(parts)]
                if any(named) and not (inside and not all(n or p in _LAYOUT_NAMES or p.isdigit() for n, p in zip(named, parts))):
                    return True
    return False


class Page:
    """The tree of a page: for each element its parent, tag and flags, and the texts in order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.drop, self.link = ["html"], [-1], [False], [False]
        self.own, self.inside = [0], [False]
        #: whether an element itself is furniture, and whether that is only for being a form
        self.named, self.by_tag = [False], [False]
        #: (element, text) in page order; a None text is a break between blocks
        self.texts: list[tuple[int, str | None]] = []
        stack = [0]
        at, end = 0, len(html)
        while at < end:
            m = _TOKEN.search(html, at)
            if (stop := m.start() if m else end) > at:
                self._text(stack[-1], html[at:stop])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(stack[-1], m[0][9:].removesuffix("]]>"), plain=True)
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(stack, tag)
                continue
            if tag in _RAW:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = close.end() if close else (end if tag in ("script", "style") else at)
                continue
            if tag in ("html", "body"):  # their tags may be given, repeated or left out
                continue
            self._open(stack, tag, m[3])
        self._keep_page_forms()

    def _keep_page_forms(self) -> None:
        """A form that holds most of the page's text outside furniture is its frame, not furniture."""
        forms = [i for i, t in enumerate(self.tag) if t == "form" and self.by_tag[i]]
        if not forms:
            return
        holder = [-1] * len(self.tag)  # the outermost form around an element
        inner = [False] * len(self.tag)  # furniture by something else than forms
        for i in range(1, len(self.tag)):  # parents come first
            up = self.parent[i]
            holder[i] = holder[up] if holder[up] >= 0 else i if self.by_tag[i] else -1
            inner[i] = inner[up] or self.named[i] and not self.by_tag[i]
        chars: dict[int, int] = {}
        for i, n in enumerate(self.own):
            if not inner[i]:
                chars[holder[i]] = chars.get(holder[i], 0) + n
        most = max(forms, key=lambda i: chars.get(i, 0))
        if 2 * chars.get(most, 0) > sum(chars.values()):
            self.drop = [inner[i] or holder[i] not in (-1, most) for i in range(len(self.tag))]

    def _text(self, node: int, raw: str, plain: bool = False) -> None:
        text = raw if plain or "&" not in raw else unescape(raw)
        self.texts.append((node, text))
        self.own[node] += len(text.strip())

    def _open(self, stack: list[int], tag: str, attrs: str) -> None:
        if tag in _CLOSES_P:
            self._implied(stack, frozenset(["p"]), _P_SCOPE)
        if tag in _IMPLIED:
            self._implied(stack, *_IMPLIED[tag])
        if tag not in _INLINE:
            self.texts.append((stack[-1], None))
        if tag in _VOID:
            return
        up = stack[-1]
        inside = self.inside[up]
        self.tag.append(tag)
        self.parent.append(up)
        named = _furniture(tag, attrs, inside)
        self.named.append(named)
        self.by_tag.append(named and tag == "form" and not _furniture("div", attrs, inside))
        self.drop.append(self.drop[up] or named)
        self.link.append(self.link[up] or tag == "a")
        self.inside.append(inside or tag in _CONTAINERS)
        self.own.append(0)
        stack.append(len(self.tag) - 1)

    def _implied(self, stack: list[int], tags: frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            t = self.tag[stack[k]]
            if t in tags:
                self.texts.append((stack[k], None))
                del stack[k:]
                return
            if t in scope:
                return

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tag[stack[k]] == tag:
                if tag not in _INLINE:
                    self.texts.append((stack[k], None))
                del stack[k:]
                return

    def densities(self) -> tuple[list[float], list[float], list[int]]:
        """(composite density, density sum, characters) of every element, furniture left out."""
        n = len(self.tag)
        chars = [0 if d else c for c, d in zip(self.own, self.drop)]
        link_chars = [c if x else 0 for c, x in zip(chars, self.link)]
        tags, link_tags = [0] * n, [0] * n
        body_chars, body_links = max(1, sum(self.own)), sum(c for c, x in zip(self.own, self.link) if x)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):  # children come after their parents
            if self.drop[i]:
                continue
            c, t, lc, lt = chars[i], max(1, tags[i]), link_chars[i], link_tags[i]
            if c:
                base = log(c / max(1, c - lc) * lc + body_links / body_chars * c + e)
                weight = log(c / max(1, lc) * t / max(1, lt)) / log(base) if base > 1.0001 else 1.0
                density[i] = c / t * max(0.0, weight)
            sums[i] += self.own[i]
            up = self.parent[i]
            if up >= 0:
                sums[up] += density[i]
                chars[up] += c
                link_chars[up] += lc
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (self.tag[i] == "a")
        return density, sums, chars

    def main(self) -> set[int]:
        """The elements that hold the main text."""
        density, sums, chars = self.densities()
        if not chars[0]:
            return set(range(len(self.tag)))
        core = max(range(len(sums)), key=lambda i: (sums[i], -i) if not self.drop[i] else (-1.0, 0))
        path = [core]
        while self.parent[path[-1]] >= 0:
            path.append(self.parent[path[-1]])
        threshold = min([density[i] for i in path[:-1]], default=density[core])
        for i in path:
            if self.tag[i] in _CONTAINERS:
                core = i
        while core and (self.tag[core] in _INLINE or self.tag[core] in ("p", "li", "td", "tr", "pre", "blockquote")):
            core = self.parent[core]
        on_path = set(path[path.index(core) + 1 :]) if core in path else set()
        keep = {core}
        for i in range(1, len(self.tag)):  # parents come first
            up = self.parent[i]
            if self.drop[i]:
                continue
            if up in keep and i != core or up in on_path and i not in on_path and i != core and self.tag[core] not in _CONTAINERS and density[i] >= threshold > 0:
                keep.add(i)
        return keep

    def text(self) -> str:
        keep = self.main()
        parts = [" " if t is None else t for i, t in self.texts if i in keep or t is None]
        return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    """The main text of one page."""
    return Page(html).text() if html else ""


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            text = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, "page_id long, url string, text string, n_chars long")
