"""Main text of web pages by inferring a wrapper for each host.

A page is a stream of tokens: start tags with their classes, end tags, texts.  A wrapper is
a union-free regular expression over such streams: sequences with optional parts, repeated
groups and text slots, and no alternatives.  It is inferred by aligning streams of the same
host one after another.  Where tags match, what stands between a start tag and its end tag
is aligned in turn.  Where they don't, the mismatch is resolved: a stretch of tokens that
repeats what stands before it, whatever its length, becomes a repeated group; one without a
counterpart along the longest common subsequence becomes optional; texts that differ become
a slot.  All pages of a host take part: each task folds its pages, and the tasks' wrappers
are folded by host.  Pages of one skeleton are merged part by part, others are aligned.

What is content is read off the wrapper.  A slot whose text differs from page to page, or
that only some pages have, counts with its characters; a text that is the same on LEAST_PAGES
pages or more is fixed and counts for nothing, as do links.  The article is the element named
so, if there is one, else the deepest one that has most of what counts.  Every page is then
matched against its host's wrapper: blocks whose texts are all fixed are left out (headings
h1 stay, and a page that would be left empty is kept whole).

Elements that never hold an article by their tag or role (menus, footers, forms and so on)
are left out.  Names of classes and ids are weaker evidence, and the wrapper decides: a part
with a name of SOFT_NAMED stays where its text varies, and a part with a name of NEVER_NAMED
stays if next to nothing that counts is found outside it.  A page that has not got the
host's element is read through a wrapper of its own, in which the host's fixed texts count
for nothing.

Defined cases: null html counts as empty and gives the empty text; so does a page without
text outside excluded parts.  A null or unreadable url belongs to the host "".  Broken
markup is read as browsers do in the main: implied end tags, unclosed elements closed by
their parent.  Repeated rows and null ids are passed through; other columns, whatever their
names, are kept.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.flat import fresh, map_arrow
from quillmill.staging import stage

LEAST_PAGES = 3
HELD_SKELETONS = 256  # a task merges what it has after so many

# Element classes of HTML, and names that pages give to parts that are no article.
VOID = frozenset(
    """
    area base br col embed hr img input link meta param source track wbr
    """.split()
)
RAW = frozenset(
    """
    script style textarea title iframe noembed noframes xmp
    """.split()
)
INLINE = frozenset(
    """
    a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr br img
    """.split()
)
CLOSES_P = frozenset(
    """
    address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul
    """.split()
)
# of an element: those that it closes, and those beyond which it closes nothing
SELF_CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "thead": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
NEVER = frozenset(
    """
    head nav header footer aside form script style noscript template button select textarea input iframe svg
    canvas object audio video dialog menu title
    """.split()
)
# names of parts that are seldom articles, as the first or the last word of a class or id
NEVER_NAMED = frozenset(
    """
    ad ads adv advert adverts advertisement advertising banner sponsor sponsored cookie cookies consent gdpr
    newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar
    footer bottombar comment comments disqus replies respond sharing recommended pagination pager toolbar login
    signup
    """.split()
)
# names that parts of articles have too, as a whole class or id
SOFT_NAMED = frozenset(
    """
    alert copyright form header hidden legal modal notice notices notification overlay popup promo promotion rail
    related search share social widget widgets
    """.split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
ARTICLES = frozenset(["article", "main"])
BY_TAG, BY_NAME, BY_SOFT_NAME = 3, 2, 1  # why an element is no article text

DEPTH = 200  # elements below this depth have no level of their own, but for those that are left out by their tag
RESCUE = 0.05  # of what counts, the share outside a named part under which the part is the article after all

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """An element: its label, whether it can hold no article text (0, or by what: BY_TAG and so on), and children, which are nodes or texts."""

    __slots__ = ("tag", "label", "never", "kids")

    def __init__(self, tag: str, label: str, never: int) -> None:
        self.tag, self.label, self.never, self.kids = tag, label, never, []


def _by_name(name: str) -> int:
    """What one class or id says."""
    parts = [x.lower() for x in _NAME.findall(name)]
    if parts and (parts[0] in NEVER_NAMED or parts[-1] in NEVER_NAMED):
        return BY_NAME
    return BY_SOFT_NAME if len(parts) == 1 and parts[0] in SOFT_NAMED else 0


def _element(tag: str, attributes: str) -> Node:
    label, never = tag, BY_TAG if tag in NEVER else 0
    if attributes and not attributes.isspace():
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        classes, role = values.get("class", "").split(), values.get("role", "").lower()
        label += "".join("." + c for c in sorted(re.sub(r"\d+", "#", c) for c in classes))
        if tag not in ("html", "body"):
            never = max([never, *map(_by_name, [*classes, *values.get("id", "").split()])])
        shown = values.get("style", "").replace(" ", "").lower()
        if role in NEVER_ROLES or "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in shown:
            never = BY_TAG
        if role == "main":
            label += "@main"
    return Node(tag, label, never)


def parse(page: str) -> Node:
    """The tree of a page; raw elements (scripts and such) keep no text."""
    root = Node("", "", 0)
    stack, pos, n = [root], 0, len(page)
    flat: dict[str, int] = {}
    while pos < n:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            text = m[0]
            if not text.startswith(("<!", "<?")):
                stack[-1].kids.append(text)
            continue
        tag = tag.lower()
        if m[1]:
            if flat.get(tag):
                flat[tag] -= 1
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in CLOSES_P or tag in SELF_CLOSING:
            close, within = ({"p"}, {"button", "td", "th", "table"}) if tag in CLOSES_P else SELF_CLOSING[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in within:
                    break
                if stack[k].tag in close:
                    del stack[k:]
                    if tag not in ("tr", "thead", "tbody", "tfoot"):
                        break
        node = _element(tag, m[3])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, pos)
            pos = n if end is None else page.find(">", end.start()) + 1 or n
        elif tag not in VOID and not m[3].endswith("/"):
            if len(stack) < DEPTH or len(stack) == DEPTH and node.never == BY_TAG:
                stack.append(node)
            else:
                flat[tag] = flat.get(tag, 0) + 1
    return root


class Part:
    """A part of a wrapper: an element, a group, or a text slot, with what the pages show of it.

    ``texts`` has the least two (hash, beginning) of its whole texts, ``ids`` the least LEAST_PAGES hashes of pages
    that have it; ``source`` says where a single page has it.  ``rescued``: it is content despite its name.
    """

    __slots__ = ("label", "tag", "never", "kids", "optional", "repeated", "texts", "chars", "links", "pages", "ids", "source", "rescued")

    def __init__(self, label: str, tag: str = "", never: int = 0, ids: tuple = ()) -> None:
        self.label, self.tag, self.never, self.ids = label, tag, never, ids
        self.kids: list[Part] = []
        self.optional = self.repeated = self.rescued = False
        self.texts: set[tuple[str, str]] = set()
        self.chars = self.links = 0
        self.pages = 1
        self.source: list = []

    def notation(self) -> str:
        """The expression: labels, #text for slots, the text itself where it never differs, + and ? as usual."""
        if self.label == "#text":
            out = "#text" if len(self.texts) != 1 else json.dumps(next(iter(self.texts))[1], ensure_ascii=False)
        else:
            inner = " ".join(k.notation() for k in self.kids)
            out = f"({inner})" if self.label.startswith("(") else f"<{self.label}>{inner and ' ' + inner + ' '}</>"
        return out + "+" * self.repeated + "?" * self.optional


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def part_of(node: Node, in_link: bool = False, ids: tuple = ("",)) -> Part:
    """A page's element as a wrapper that only this page fits, its repetitions folded."""
    out = Part(node.label, node.tag, node.never, ids)
    out.source.append(id(node))
    in_link = in_link or node.tag == "a"
    for i, kid in enumerate(node.kids):
        if isinstance(kid, Node):
            out.kids.append(part_of(kid, in_link, ids))
        elif not kid.isspace():
            slot, text = Part("#text", ids=ids), kid.strip()
            slot.texts.add((_digest(text), text[:40]))
            slot.source.append((id(node), i))
            slot.chars, slot.links = len(kid), len(kid) * in_link
            out.kids.append(slot)
    out.kids = _folded(out.kids)
    return out


def page_part(page: str) -> Part:
    return part_of(parse(page), ids=(_digest(page),))


def _folded(kids: list[Part]) -> list[Part]:
    """Stretches that repeat what stands before them, first single parts and then groups of any length, as one repeated part."""
    if len(kids) < 2:
        return kids
    for grouped in (False, True):
        labels = [k.label for k in kids]
        after, later = [0] * len(kids), {}
        for k in range(len(kids) - 1, -1, -1):  # where a label comes next
            after[k] = later.get(labels[k], 0)
            later[labels[k]] = k
        i, out = 0, []
        while i < len(kids):
            size = after[i] - i if grouped else 1
            end = i + max(size, 1)
            while size > 0 and labels[end : end + size] == labels[i : i + size]:
                end += size
            if size < 1 or end == i + size:
                out.append(kids[i])
                i += 1
                continue
            runs = [kids[j : j + size] for j in range(i, end, size)]
            group = runs[0]
            for other in runs[1:]:
                group = [merged(a, b, same_page=True) for a, b in zip(group, other, strict=True)]
            if size == 1:
                fold = group[0]
            else:
                fold = Part("(" + " ".join(labels[i : i + size]) + ")", ids=group[0].ids)
                fold.kids = group
            fold.repeated = True
            out.append(fold)
            i = end
        kids = out
    return kids


def merged(a: Part, b: Part, same_page: bool = False) -> Part:
    """The least wrapper of this form that fits what ``a`` and ``b`` fit; they have one label."""
    out = Part(a.label, a.tag, min(a.never, b.never), a.ids if a.ids == b.ids else tuple(sorted({*a.ids, *b.ids})[:LEAST_PAGES]))
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.chars, out.links = a.chars + b.chars, a.links + b.links
    out.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    out.texts = a.texts | b.texts
    if same_page:
        out.source = a.source + b.source
    if len(out.texts) > 2:
        out.texts = set(sorted(out.texts)[:2])
    if [k.label for k in a.kids] == [k.label for k in b.kids]:
        out.kids = [merged(x, y, same_page) for x, y in zip(a.kids, b.kids, strict=True)]
        return out
    kids: list[Part] = []
    for x, y in _aligned(a.kids, b.kids):
        if x is not None and y is not None:
            kids.append(merged(x, y, same_page))
        else:
            only = y if x is None else x
            only.optional = True
            kids.append(only)
    out.kids = _folded(kids)
    return out


CELLS = 1 << 21  # of a table of common subsequences; longer lists are halved first


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row i, column j: the length of the longest common subsequence of a[i:] and b[j:]."""
    best = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        best[i] = _row(best[i + 1], a[i], b)
    return best


def _row(below: np.ndarray, x: int, b: np.ndarray) -> np.ndarray:
    out = below.copy()
    np.maximum(out[:-1], below[1:] + (b == x), out=out[:-1])
    return np.maximum.accumulate(out[::-1])[::-1]


def _common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places that correspond along a longest common subsequence; memory grows with the sum of the lengths."""
    if not len(a) or not len(b):
        return []
    if len(a) == 1 or len(a) * len(b) <= CELLS:
        best, out, i, j = _lengths(a, b) if len(a) > 1 else None, [], 0, 0
        if best is None:
            at = np.flatnonzero(b == a[0])
            return [(0, int(at[0]))] if len(at) else []
        while i < len(a) and j < len(b):
            if a[i] == b[j]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1, j] >= best[i, j + 1]:
                i += 1
            else:
                j += 1
        return out
    half = len(a) // 2
    ahead, behind = np.zeros(len(b) + 1, np.int32), np.zeros(len(b) + 1, np.int32)
    for x in a[half:][::-1]:
        ahead = _row(ahead, x, b)
    for x in a[:half]:
        behind = _row(behind, x, b[::-1])
    cut = int(np.argmax(ahead + behind[::-1]))
    return _common(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _common(a[half:], b[cut:])]


def _aligned(a: list, b: list) -> list[tuple]:
    """Pairs along the longest common subsequence of the labels, None where one list has no counterpart."""
    lo, n, m = 0, len(a), len(b)
    while lo < min(n, m) and a[lo].label == b[lo].label:
        lo += 1
    while min(n, m) > lo and a[n - 1].label == b[m - 1].label:
        n, m = n - 1, m - 1
    out = list(zip(a[:lo], b[:lo], strict=True))
    number: dict[str, int] = {}
    x = np.array([number.setdefault(k.label, len(number)) for k in a[lo:n]], np.int64)
    y = np.array([number.setdefault(k.label, len(number)) for k in b[lo:m]], np.int64)
    i = j = lo
    for p, q in [*_common(x, y), (n - lo, m - lo)]:
        out += [(k, None) for k in a[i : lo + p]] + [(None, k) for k in b[j : lo + q]]
        if p < n - lo and q < m - lo:
            out.append((a[lo + p], b[lo + q]))
        i, j = lo + p + 1, lo + q + 1
    return [*out, *zip(a[n:], b[m:], strict=True)]


def _packed(p: Part) -> list:
    return [p.label, p.tag, p.never, p.optional, p.repeated, sorted(p.texts), p.chars, p.links, p.pages, p.ids, [_packed(k) for k in p.kids]]


def _unpacked(v: list) -> Part:
    out = Part(v[0], v[1], v[2], tuple(v[9]))
    out.optional, out.repeated, out.texts, out.chars, out.links, out.pages = v[3], v[4], {tuple(x) for x in v[5]}, v[6], v[7], v[8]
    out.kids = [_unpacked(k) for k in v[10]]
    return out


def _skeleton(p: Part) -> tuple:
    return (p.label, *map(_skeleton, p.kids))


class Fold:
    """Wrappers by host of any number of pages; pages of one skeleton are merged before those are aligned."""

    def __init__(self) -> None:
        self.done: dict[str, Part] = {}
        self.held: dict[tuple, Part] = {}

    def add(self, host: str, part: Part) -> None:
        key = (host, _skeleton(part))
        have = self.held.get(key)
        self.held[key] = part if have is None else merged(have, part)
        if len(self.held) > HELD_SKELETONS:
            self.flush()

    def flush(self) -> dict[str, Part]:
        for (host, _), part in sorted(self.held.items(), key=lambda x: (x[0][0], repr(x[0][1]))):
            self.done[host] = merged(self.done[host], part) if host in self.done else part
        self.held = {}
        return self.done


def infer(pages: list[str]) -> Part:
    """The wrapper of some pages of one host."""
    wrapper = page_part(pages[0])
    for page in pages[1:]:
        wrapper = merged(wrapper, page_part(page))
    return wrapper


class Known:
    """What extraction needs of a wrapper: labels to align by, which slots are fixed, which soft-named parts vary."""

    __slots__ = ("label", "fixed", "varies", "kids")

    def __init__(self, v: list) -> None:
        self.label, self.fixed, self.varies = v[0], v[1], v[2]
        self.kids = [Known(k) for k in v[3]]


def known(part: Part) -> list:
    often = len(part.ids) >= LEAST_PAGES
    fixed = next(iter(part.texts))[0] if often and part.label == "#text" and len(part.texts) == 1 else ""
    varies = part.rescued or often and part.never == BY_SOFT_NAME and sum(map(_mass, part.kids)) > 0
    kids = [] if part.never > BY_SOFT_NAME or part.tag == "h1" else [known(k) for k in part.kids]
    return [part.label, fixed, varies, kids if any(k[1] or k[2] or k[3] for k in kids) else []]


def rescue(wrapper: Part) -> Part:
    """Marks as content the named part that has what counts, if next to nothing that counts stands outside it."""
    while True:
        named: list[tuple[float, Part]] = []

        def look(part: Part) -> None:
            for kid in part.kids:
                if kid.never in (BY_NAME, BY_SOFT_NAME):
                    named.append((sum(map(_mass, kid.kids)), kid))
                if kid.never != BY_TAG:
                    look(kid)

        look(wrapper)
        most, part = max(named, key=lambda x: x[0], default=(0.0, wrapper))
        if _mass(wrapper) >= RESCUE * most:
            return wrapper
        part.never, part.rescued = 0, True


def _matched(part: Part, wrapper: Known, fixed: set, varying: set) -> None:
    """Aligns a page with its host's wrapper; fixed slots weigh nothing afterwards."""
    if wrapper.fixed and {x for x, _ in part.texts} == {wrapper.fixed}:
        fixed.update(part.source)
        part.chars = part.links = 0
    if wrapper.varies:
        varying.update(part.source)
    if wrapper.kids:
        for a, b in _aligned(part.kids, wrapper.kids):
            if a is not None and b is not None:
                _matched(a, b, fixed, varying)


def _mass(part: Part) -> float:
    """Characters that are no link and that vary (or that only one page has shown), outside parts that are never article."""
    if part.never:
        return 0.0
    if part.label == "#text":
        fixed = len(part.ids) > 1 and len(part.texts) == 1
        return 0.0 if fixed else part.chars - part.links
    return sum(map(_mass, part.kids))


def region(wrapper: Part) -> list[str]:
    """The labels from the root to the element that holds the articles."""
    named: list[tuple[float, list[str]]] = []

    def look(part: Part, path: list[str]) -> None:
        for kid in part.kids:
            if kid.never or kid.label == "#text":
                continue
            here = path if kid.label.startswith("(") else [*path, kid.label]
            if kid.tag in ARTICLES or kid.label.endswith("@main"):
                named.append((_mass(kid), here))
            look(kid, here)

    look(wrapper, [])
    if named:
        # of nested ones the outer, unless what lies outside the inner one is fixed or excluded
        most = max(x for x, _ in named)
        return max((p for x, p in named if x >= most), key=len)
    path, at = [], wrapper
    while True:
        total = _mass(at)
        inner = [k for k in at.kids if not k.never and k.label != "#text" and k.tag not in INLINE]
        top = max(inner, key=_mass, default=None)
        if top is None or not total or _mass(top) < 0.8 * total or top.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "pre", "blockquote"):
            return path
        if not top.label.startswith("("):
            path = [*path, top.label]
        at = top


def _rescued(part: Part, varying: set) -> None:
    """Adds the sources of parts that are content despite their names."""
    if part.rescued:
        varying.update(part.source)
    for kid in part.kids:
        _rescued(kid, varying)


def _found(root: Node, path: list[str]) -> list[Node]:
    level = [root]
    for label in path:
        level = [k for node in level for k in node.kids if isinstance(k, Node) and k.label == label]
    return level


def blocks(node: Node, fixed: set | frozenset = frozenset(), varying: set | frozenset = frozenset()) -> list[str]:
    """The texts of the blocks under an element, in page order, as they are in the source; without those of fixed texts alone."""
    out: list[list[str]] = [[]]
    kept = [False]

    def walk(x: Node) -> None:
        for i, kid in enumerate(x.kids):
            if not isinstance(kid, Node):
                out[-1].append(kid)
                kept[-1] = kept[-1] or not kid.isspace() and (id(x), i) not in fixed
            elif kid.tag == "br":
                out[-1].append(" ")
            elif not kid.never or id(kid) in varying:
                if kid.tag in INLINE:
                    walk(kid)
                else:
                    out.append([])
                    kept.append(False)
                    walk(kid)
                    out.append([])
                    kept.append(False)

    walk(node)
    return ["".join(x) for x, keep in zip(out, kept, strict=True) if keep]


def text_of(page: str, path: list[str] | None, wrapper: Known | None = None) -> str:
    """The main text of a page whose host keeps articles at ``path`` and has the ``wrapper``."""
    if not page:
        return ""
    root = parse(page)
    fixed: set = set()
    varying: set = set()
    nodes, part = _found(root, path) if path else [], None
    if not nodes or wrapper is not None and wrapper.kids:
        part = part_of(root)
        if wrapper is not None:
            _matched(part, wrapper, fixed, varying)
    if not nodes:
        nodes = _found(root, region(rescue(part)))
        _rescued(part, varying)

    def said(fixed: set) -> str:
        clean = (_SPACE.sub(" ", html.unescape(b)).strip() for node in nodes for b in blocks(node, fixed, varying))
        return " ".join(x for x in clean if x)

    return said(fixed) or said(set())


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", sample_pages: int | None = None) -> DataFrame:
    """``(host, pages, wrapper, path, known)``: for each host its expression, where its articles are, and what pages are read by.

    All pages form the wrapper; ``sample_pages`` limits them to those first by a hash.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(html_col, F.lit("")).alias("html")).where("html <> ''")
    if sample_pages is not None:
        order = Window.partitionBy("host").orderBy(F.xxhash64("html"), "html")
        # the rank is limited before rows are dealt by host, so a host gives at most this many for each task
        rows = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_pages).drop("r")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Fold()
        for b in batches:
            for host, page in zip(b.column(0), b.column(1), strict=True):
                fold.add(host.as_py(), page_part(page.as_py()))
        for host, found in sorted(fold.flush().items()):
            yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([json.dumps(_packed(found))], pa.string())], names=["host", "part"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fold = Fold()
        for x in sorted(pdf["part"]):
            fold.add(pdf["host"].iloc[0], _unpacked(json.loads(x)))
        found = fold.flush()[pdf["host"].iloc[0]]
        row = {"host": pdf["host"].iloc[0], "pages": found.pages, "wrapper": found.notation(), "path": json.dumps(region(rescue(found)))}
        return pd.DataFrame([row | {"known": json.dumps(known(found))}])

    parts = map_arrow(rows, part, T.StructType([T.StructField("host", T.StringType()), T.StructField("part", T.StringType())]))
    return parts.groupBy("host").applyInPandas(run, "host string, pages long, wrapper string, path string, known string")


def extract(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", out: str = "text", sample_pages: int | None = None) -> DataFrame:
    """``pages`` with its main text in ``out`` in place of the html; a column of that name gives way."""
    found = wrappers(pages, url_col=url_col, html_col=html_col, sample_pages=sample_pages)
    host, path, page = (fresh(pages, c) for c in ("host", "path", "page"))
    by_host = stage(found.select(F.col("host").alias(host), F.concat_ws("\n", "path", "known").alias(path)), "wrappers")
    keep = [c for c in pages.columns if c not in (html_col, out)]
    # the table's size is known from its files: the optimiser broadcasts it only below its limit
    joined = pages.join(by_host, host_of(F.col(f"`{url_col}`")) == F.col(host), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in keep], path, F.col(f"`{html_col}`").alias(page))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: dict = {None: (None, None)}
        for b in batches:
            n = b.num_columns
            texts = []
            for path, page in zip(b.column(n - 2), b.column(n - 1), strict=True):
                path = path.as_py()
                if path not in paths:
                    if len(paths) > 1000:
                        paths = {None: (None, None)}
                    at, wrapper = path.split("\n")
                    paths[path] = json.loads(at), Known(json.loads(wrapper))
                texts.append(text_of(page.as_py() or "", *paths[path]))
            yield pa.RecordBatch.from_arrays([*b.columns[: n - 2], pa.array(texts, pa.string())], names=[*keep, out])

    schema = T.StructType([*joined.schema.fields[:-2], T.StructField(out, T.StringType())])
    return map_arrow(joined, run, schema)


def op7_html(spark, sf_dir: str) -> DataFrame:
    """Query: the main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
