"""Main text of web pages by wrapper induction over the pages of a host.

Every page becomes a DOM tree. Pages of one host and layout are aligned with a reference page of the same host
and layout by simple tree matching (the largest order-preserving match of two labelled trees, by dynamic
programming over their children). A reference node at which nearly all aligned pages hold one text is template; one whose
text varies is a content slot. Pages that agree in the main varying text are copies of each other and share one
vote: what they share is their article. Text outside the template, in page order, is the main text.

Alignment cannot see furniture that varies from page to page (rotating adverts, per-page menus, comments), so
regions that the markup itself names as furniture are no content: menus, footers, asides, scripts and so on by
element or role; headers, forms, notices, adverts and so on by element or whole class name unless they hold the main
varying text of the page. Where the page marks its article (``article``, ``main``) and that holds most of what varies,
content lies inside it.

Layout of the work: every (host, layout) with enough pages has a reference; a layout with fewer takes the most
similar reference of its host. Votes are one narrow row of hashes per page, and the wrappers are broadcast if their
checked size allows, else shuffle-joined on (host, layout). No host's pages are gathered. Equal pages share one vote.

Defined results: a NULL or empty page, or one without content, gives the empty text; a NULL url is a host of its
own; a host with too few different pages has no template and keeps all that is not furniture; repeated rows are
pages of their own.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake.session import materialize

CANDIDATES = 16  # references of a host that a layout without its own is compared with
MIN_VOTERS = 3  # different pages that must be aligned with a node
CONSTANT_SHARE = 0.9  # of which so many hold the same text
BROADCAST_BYTES = 64 << 20
LAYOUT_ENTRIES = 64
MATCHES = 200_000  # node pairs of known tree matches that a task keeps
NAMES = 4096  # elements of different names that a worker keeps, each of at most so many characters of attributes:
NAME_CHARS = 256
EXACT_CELLS = 40_000  # tables of child lists up to this product are kept whole, of larger ones some rows: the match is the same

# Element kinds of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "select", "object", "canvas", "math",
       "audio", "video", "title")
BLOCKS = set("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure
 footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot
 th thead tr ul""".split())
FURNITURE = set("nav footer aside form button dialog menu head label input fieldset".split()) | set(RAW)
AROUND = {"form", "fieldset", "header", "dialog"}  # elements and roles that may stand around the story
COMMENTS = {"comment", "comments", "disqus", "respond", "replies"}  # may be longer than the story
CONTAINERS = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
CLASS_WORDS = set("""ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner
 sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead notice notices cookie cookies consent gdpr
 popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment
 comments disqus respond replies pagination pager widget toolbar""".split())
OUTER_WORDS = {"header", "topbar"}
STRUCTURE = set("html body main article section div header footer nav aside form table".split())
_CLOSES_P = BLOCKS - {"body", "html"}
_SAME = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"},
         "tr": {"tr", "td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "tr": {"table"}}
# The last group is missing where a quote or the tag itself has no end.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>"']*+)(?:((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>)?+""", re.S)
_STOP = re.compile("[>\"']")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_COMPOUND = re.compile("[-_]+")
_RELATIONS = {"has", "no", "with", "without", "is", "not", "hide", "show"}


def markup(source: str) -> Iterator[tuple[int, int, str, str | None, str]]:
    """(start, end, "/" if it closes, tag or None, attributes) of each markup, in one forward scan whatever its quotes.

    A quote without an end is a character, so its tag closes at the next ``>``; from a tag without ``>`` on all is
    text. An element whose content is no markup ends after its end tag, or with the page.
    """
    gone: set[str] = set()  # quotes that do not occur any more
    at: int | None = 0
    while at is not None:
        start_at, at = at, None
        for m in _MARKUP.finditer(source, start_at):
            start, end = m.span()
            closing, tag, raw = m.groups()
            if tag is None:
                yield start, end, "", None, ""
                continue
            tag = tag.lower()
            if raw is None:
                at = _tag_end(source, end, gone)
                if at < 0:
                    return
                raw, end = source[end:at - 1], at
            if not closing and tag in _RAW_END:
                close = _RAW_END[tag].search(source, end)
                at = end = close.end() if close else len(source)
            yield start, end, closing, tag, raw
            if at is not None:
                break


def _tag_end(source: str, at: int, gone: set[str]) -> int:
    while m := _STOP.search(source, at):
        mark, at = m.group(), m.end()
        if mark == ">":
            return at
        if mark not in gone:
            other = source.find(mark, at)
            if other < 0:
                gone.add(mark)
            else:
                at = other + 1
    return -1


class Element(NamedTuple):
    """What the name and the attributes of an element say, whatever stands around it."""

    label: str
    container: bool  # marks the article
    drop: bool
    around: bool  # furniture that may stand around the story
    around_outside: bool  # the same, unless inside a marked article
    named: bool  # by its class or id
    outer: bool  # the same, unless inside a marked article
    comments: bool


def _element(tag: str, raw: str) -> Element:
    attrs: dict[str, str] = {}
    if raw and not raw.isspace():
        for m in _ATTR.finditer(raw):
            attrs.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    names = (attrs.get("class", "") + " " + attrs.get("id", "")).lower()
    role = attrs.get("role")
    words: set[str] = set()
    if names.strip() and tag not in ("html", "body", "main"):
        # Whole names, numbers aside. An article element is furniture only as a reader comment.
        words = {w.strip("-_") for w in re.sub(r"\d+", "", names).split()}
        # Of a compound name the first or the last part counts, unless it says that the element has such a thing.
        parts = [w for w in (_COMPOUND.split(w) for w in words) if len(w) > 1 and w[0] not in _RELATIONS and w[-2] not in _RELATIONS]
        words |= {w[0] for w in parts} | {w[-1] for w in parts}
    known = CLASS_WORDS if tag != "article" else {"comment", "comments"}
    # Page-wide elements carry names of the page itself (title or category slugs).
    own = re.sub(r"\d+", "", names.strip()) if tag not in ("html", "body", *CONTAINERS) else ""
    return Element(
        label=f"{tag}.{own}" if own else tag,
        container=tag in CONTAINERS or role in ("main", "article") or attrs.get("itemprop") == "articleBody",
        drop=tag in FURNITURE - AROUND or role in ROLES - AROUND or "hidden" in attrs,
        around=(tag in AROUND and tag != "header") or role in ROLES & AROUND, around_outside=tag == "header",
        named=bool(words & known), outer=bool(words & OUTER_WORDS), comments=bool(words & COMMENTS))


_known_element = lru_cache(NAMES)(_element)


class Page:
    """DOM of one page in flat arrays: label, parent and children of every element, and its text blocks."""

    __slots__ = ("label", "parent", "children", "drop", "named", "inside", "blocks", "size", "shape")

    def __init__(self, source: str):
        self.label, self.parent, self.children = ["#"], [-1], [[]]
        self.drop, self.inside = [False], [False]
        self.named = [0]  # 1 if its name says furniture, which its text may overrule, 2 for reader comments
        self.blocks: list[tuple[int, str]] = []  # (element, text) in page order
        self._read(source)
        n = len(self.label)
        self.size, self.shape = [1] * n, [0] * n
        for i in range(n - 1, -1, -1):  # children follow their parents
            kids = self.children[i]
            if kids:
                self.size[i] = 1 + sum([self.size[k] for k in kids])
                self.shape[i] = hash((self.label[i], *[self.shape[k] for k in kids]))
            else:
                self.shape[i] = hash((self.label[i],))

    def _open(self, tag: str, raw: str, parent: int) -> int:
        e = _known_element(tag, raw) if len(raw) <= NAME_CHARS else _element(tag, raw)
        within, at = self.inside[parent], len(self.label)
        inside, drop = within or e.container, self.drop[parent] or e.drop
        named = e.around or (e.around_outside and not within) or (not drop and (e.named or (e.outer and not inside)))
        self.label.append(e.label)
        self.parent.append(parent)
        self.children.append([])
        self.children[parent].append(at)
        self.drop.append(drop)
        self.named.append(0 if not named else 2 if e.comments and not drop else 1)
        self.inside.append(inside)
        return at

    def _read(self, source: str) -> None:
        stack, tags, holder = [0], ["#"], [0]  # open elements, their tags, the elements that text in them belongs to
        text: list[str] = []
        at = 0

        def flush() -> None:
            if text:
                t = " ".join(entities.unescape("".join(text)).split())
                text.clear()
                if t:
                    self.blocks.append((holder[-1], t))

        def close(depth: int) -> None:
            flush()
            del stack[depth:], tags[depth:], holder[depth:]

        for start, end, closing, tag, raw in markup(source):
            if start > at:
                text.append(source[at:start])
            at = end
            if tag is None:
                continue
            if closing:
                if tag in tags:
                    depth = len(tags) - 1
                    if tags[-1] != tag:
                        depth -= tags[::-1].index(tag)
                    if tag in BLOCKS or tag in FURNITURE:
                        close(depth)
                    elif not any(t in BLOCKS for t in tags[depth + 1:]):
                        del stack[depth:], tags[depth:], holder[depth:]
                elif tag == "p":
                    flush()
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in BLOCKS:
                flush()
                if tag in _CLOSES_P and "p" in tags:
                    close(len(tags) - 1 - tags[::-1].index("p"))
                if tag in _SAME:
                    for depth in range(len(tags) - 1, 0, -1):
                        if tags[depth] in _SCOPE[tag]:
                            break
                        if tags[depth] in _SAME[tag]:
                            close(depth)
                            break
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag in _RAW_END:
                continue
            if tag in FURNITURE:
                flush()
            stack.append(self._open(tag, raw, stack[-1]))
            tags.append(tag)
            holder.append(stack[-1] if tag in BLOCKS or tag in FURNITURE else holder[-1])
        if at < len(source):
            text.append(source[at:])
        flush()


def layout(source: str | None) -> str:
    """Structural elements at the top of a page, repeats folded: what separates kinds of pages of a host.

    Class and id words have no part in it, since they may be the page's own. The key ends after ``LAYOUT_ENTRIES``
    elements: it only groups pages, whose alignment is by whole trees.
    """
    tags: list[str] = []
    out: list[str] = []
    for _, _, closing, tag, _ in markup(source or ""):
        if tag not in STRUCTURE:
            continue
        if closing:
            if tag in tags:
                del tags[len(tags) - 1 - tags[::-1].index(tag):]
        else:
            tags.append(tag)
            if len(tags) < 4 and out[-1:] != [f"{len(tags)}{tag}"]:
                out.append(f"{len(tags)}{tag}")
                if len(out) == LAYOUT_ENTRIES:
                    break
    return ">".join(out)


def align(a: Page, b: Page) -> dict[int, int]:
    """Simple tree matching: node of ``b`` by node of ``a`` for a largest match of the two trees.

    Equal subtrees at either end of two child lists match whole, which is optimal; dynamic programming runs over
    what is left between them. Elements of one kind whose names are not found among the other's siblings match
    too: such names may be the page's own. A weight depends on the shapes of two subtrees alone and is computed once
    for them. The match is exact for lists of any length; of a large table some rows are kept and the others computed
    again where they are read. No step recurses, so depth has no limit.
    """
    weight: dict[tuple[int, int], int] = {}

    def known(p: int, q: int) -> int | None:
        return a.size[p] if a.shape[p] == b.shape[q] else weight.get((a.shape[p], b.shape[q]))

    def trim(x: list[int], y: list[int]) -> tuple[int, int]:
        lo = 0
        while lo < len(x) and lo < len(y) and a.shape[x[lo]] == b.shape[y[lo]]:
            lo += 1
        hi = 0
        while hi < min(len(x), len(y)) - lo and a.shape[x[-1 - hi]] == b.shape[y[-1 - hi]]:
            hi += 1
        return lo, hi

    def keys(x: list[int], y: list[int]) -> tuple[list[str], list[str]]:
        """Labels of the other list count as they are, others by their element."""
        left, right = [a.label[p] for p in x], [b.label[q] for q in y]
        if left and right:
            mine, theirs = set(left), set(right)
            left = [k if k in theirs else k.split(".", 1)[0] + "." for k in left]
            right = [k if k in mine else k.split(".", 1)[0] + "." for k in right]
        return left, right

    def kinds(x: list[int], y: list[int]) -> tuple[dict[int, tuple[int, str]], dict[int, tuple[int, str]]]:
        """A child and its key for every different shape of two lists."""
        left, right = keys(x, y)
        return ({a.shape[p]: (p, k) for p, k in zip(x, left)}, {b.shape[q]: (q, k) for q, k in zip(y, right)})

    def wanted(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """Child pairs whose weight is needed and not known yet."""
        left, right = kinds(x, y)
        return [(p, q) for p, k in left.values() for q, m in right.values() if k == m and known(p, q) is None]

    def rows(x: list[int], y: list[int]):
        """A function from the place of a child of the first list and its row of the table to the next row."""
        left, right = kinds(x, y)
        gain = {s: np.array([known(p, q) if k == m else 0 for q, m in right.values()], np.int64) for s, (p, k) in left.items()}
        place = {s: i for i, s in enumerate(right)}
        at = np.array([place[b.shape[q]] for q in y])

        def following(i: int, above: np.ndarray) -> np.ndarray:
            out = np.zeros(len(y) + 1, np.int64)
            np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gain[a.shape[x[i]]][at]), out=out[1:])
            return out

        return following

    def best(x: list[int], y: list[int]) -> int:
        """Weight of the best match of two lists."""
        if len(x) * len(y) <= EXACT_CELLS:
            return table(x, y)[-1][-1]
        following, row = rows(x, y), np.zeros(len(y) + 1, np.int64)
        for i in range(len(x)):
            row = following(i, row)
        return int(row[-1])

    def matched(x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """The pairs of the best match of two lists."""
        out = []
        i, j = len(x), len(y)
        if i * j <= EXACT_CELLS:
            m, first, step = table(x, y), 0, i + 1
        else:
            following, row, step = rows(x, y), np.zeros(j + 1, np.int64), int(i**0.5) + 1
            kept = {0: row}
            for k in range(i):
                row = following(k, row)
                if (k + 1) % step == 0:
                    kept[k + 1] = row
            first = i + 1  # no rows at hand yet
        while i and j:
            if i - 1 < first:  # rows from the kept one above up to this one
                first = (i - 1) // step * step
                m = [kept[first]]
                for k in range(first, i):
                    m.append(following(k, m[-1]))
            here, above = m[i - first], m[i - 1 - first]
            if here[j] == above[j]:
                i -= 1
            elif here[j] == here[j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((x[i], y[j]))
        return out

    def table(x: list[int], y: list[int]) -> list[list[int]]:
        m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        left, right = keys(x, y)
        for i, p in enumerate(x):
            row, above = m[i + 1], m[i]
            for j, q in enumerate(y):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if left[i] == right[j]:
                    w = above[j] + known(p, q)
                    row[j + 1] = w if w > best else best
                else:
                    row[j + 1] = best
        return m

    def weigh(p: int, q: int) -> None:
        """The weight of a pair of nodes, children before parents."""
        todo = [(p, q)]
        while todo:
            p, q = todo[-1]
            if known(p, q) is not None:
                todo.pop()
                continue
            x, y = a.children[p], b.children[q]
            lo, hi = trim(x, y)
            u, v = x[lo:len(x) - hi], y[lo:len(y) - hi]
            missing = wanted(u, v)
            if missing:
                todo += missing
                continue
            inner = best(u, v) if u and v else 0
            weight[a.shape[p], b.shape[q]] = 1 + inner + sum(a.size[k] for k in x[:lo]) + sum(a.size[k] for k in x[len(x) - hi:])
            todo.pop()

    weigh(0, 0)
    pairs: dict[int, int] = {}
    todo = [(0, 0)]
    while todo:
        p, q = todo.pop()
        pairs[p] = q
        x, y = a.children[p], b.children[q]
        lo, hi = trim(x, y)
        todo += zip(x[:lo], y[:lo])
        if hi:
            todo += zip(x[-hi:], y[-hi:])
        if lo + hi < min(len(x), len(y)):
            todo += matched(x[lo:len(x) - hi], y[lo:len(y) - hi])
    return pairs


def _by_node(page: Page) -> dict[int, list[str]]:
    out = defaultdict(list)
    for node, text in page.blocks:
        if not page.drop[node]:
            out[node].append(text)
    return out


def vote(page: Page, ref: Page, pairs: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(reference node, hash of the text, hash and size of its words without numbers) of the aligned text nodes."""
    theirs = {n for n, _ in ref.blocks if not ref.drop[n]}
    out = []
    for node, texts in _by_node(page).items():
        q = pairs.get(node)
        if q in theirs:
            text = "\n".join(texts)
            words = " ".join([w for w in text.split() if w[0].isalpha() or any(map(str.isalpha, w))])
            out.append((q, _hash(text), _hash(words), len(words)))
    return out


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def main_text(page: Page, pairs: dict[int, int], template: set[int]) -> str:
    """Texts that are neither furniture nor aligned with the template, one block a line.

    Names decide only about elements without the main varying text: one that holds over half of what varies, and
    every marked article of it, is no furniture. A marked article bounds the content if it holds over half of it.
    """
    kept = [(n, t) for n, t in page.blocks if not page.drop[n] and pairs.get(n) not in template]
    whole, marked = sum(len(t) for _, t in kept), sum(len(t) for n, t in kept if page.inside[n])
    held: dict[int, list[int]] = defaultdict(lambda: [0, 0])  # by named element: text, and that of marked articles
    above: dict[int, list[int]] = {}
    for n, t in kept:
        if n not in above:
            above[n], at = [], n
            while at > 0:
                if page.named[at]:
                    above[n].append(at)
                at = page.parent[at]
        for k in above[n]:
            held[k][0] += len(t)
            held[k][1] += len(t) if page.inside[n] else 0
    out = {k for k, (size, own) in held.items()
           if 2 * size <= whole or own < marked or (page.named[k] == 2 and not marked)}
    kept = [(n, t) for n, t in kept if out.isdisjoint(above[n])]
    if 2 * sum(len(t) for n, t in kept if page.inside[n]) > sum(len(t) for _, t in kept):
        kept = [(n, t) for n, t in kept if page.inside[n]]
    return "\n".join(t for _, t in kept)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))


def _layout_udf():
    @F.pandas_udf("string")
    def of(pages: pd.Series) -> pd.Series:
        return pages.map(layout)

    return of


def _similar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The most similar layout among the host's references."""
    for f in frames:
        out = []
        for mine, known in zip(f["layout"], f["known"], strict=True):
            tags = mine.split(">")
            out.append(max(sorted(known), key=lambda k: SequenceMatcher(None, tags, k.split(">"), False).ratio()))
        yield pd.DataFrame({"host": f["host"], "layout": f["layout"], "ref": out})


class _Refs(dict):
    """Parsed reference pages of a task, by their source, and known matches of other trees with theirs."""

    def __init__(self):
        super().__init__()
        self.matches: dict[tuple[int, ...], dict[int, int]] = {}
        self.held = 0

    def align(self, page: Page, ref: Page) -> dict[int, int]:
        """``align``, which depends on the two trees alone: pages of one shape have one match."""
        key = (page.shape[0], len(page.label), ref.shape[0], len(ref.label))
        pairs = self.matches.get(key)
        if pairs is None:
            pairs = align(page, ref)
            self.held += len(pairs)
            if self.held > MATCHES:
                self.matches.clear()
                self.held = len(pairs)
            self.matches[key] = pairs
        return pairs

    def __missing__(self, source: str) -> Page:
        if len(self) >= 2000:
            self.clear()
        page = self[source] = Page(source)
        return page


def _votes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One narrow row per page: what it holds at each reference node; node -1 counts the voter."""
    memo = _Refs()
    for f in frames:
        out = []
        for host, ref, source, h, known in zip(f["host"], f["ref"], f["html"], f["h"], f["ref_html"], strict=True):
            page, other = Page(source), memo[known]
            votes = [(-1, 0, 0, 0), *vote(page, other, memo.align(page, other))]
            out.append((host, ref, h, *map(list, zip(*votes))))
        yield pd.DataFrame(out, columns=["host", "ref", "h", "node", "text", "words", "size"])


_VOTES = "host string, ref string, h long, node array<int>, text array<long>, words array<long>, size array<int>"


def _counted(votes: DataFrame, equal: DataFrame) -> DataFrame:
    """(host, ref, votes array<struct<node, matched, same>>): pages at a node, and those with its commonest text.

    Pages that ``equal`` (h, count) counts as the same share one vote.
    The node with the most differing text holds the main varying text of a layout. Pages that have the same words
    there (numbers aside) are copies and share one vote, however much text they share elsewhere. Where no node
    differs, all pages are copies and there are no votes.
    """
    of = ["host", "ref"]
    each = votes.select(*of, F.explode(F.arrays_zip("node", "words", "size")).alias("v")).select(*of, "v.*")
    main = (
        each.groupBy(*of, "node", "words").agg(F.max("size").alias("n"))
        .groupBy(*of, "node").agg((F.sum("n") - F.max("n")).alias("differ"))
        .groupBy(*of).agg(F.max(F.struct("differ", "node")).alias("main")).where("main.differ > 0")
    )
    main = materialize(main.select(*of, F.col("main.node").alias("main")), "page-main-nodes")
    at_main = F.expr("element_at(words, cast(array_position(node, main) as int))")
    story = F.when(F.array_contains("node", F.col("main")), at_main).otherwise(F.col("h"))
    pages = _joined(votes.join(main, of).withColumn("story", story).select(*of, "h", "story", "node", "text"), equal, ["h"])
    pages = pages.withColumn("weight", 1.0 / F.coalesce("count", F.lit(1)))
    copies = materialize(
        pages.groupBy(*of, "story").agg(F.sum("weight").alias("held")).where("held > 1"), "page-copies")
    shared = pages.join(copies, [*of, "story"], "left").withColumn(
        "weight", F.col("weight") / F.coalesce("held", F.lit(1.0)))
    return (
        shared.select(*of, "weight", F.explode(F.arrays_zip("node", "text")).alias("v")).select(*of, "weight", "v.*")
        .groupBy(*of, "node", "text").agg(F.sum("weight").alias("pages"))
        .groupBy(*of, "node").agg(F.sum("pages").alias("matched"), F.max("pages").alias("same"))
        .groupBy(*of).agg(F.collect_list(F.struct("node", "matched", "same")).alias("votes"))
    )


def _templates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Template nodes of every reference from the summed votes."""
    for f in frames:
        out = []
        for host, ref, source, votes in zip(f["host"], f["ref"], f["ref_html"], f["votes"], strict=True):
            page, got = Page(source), {v["node"]: v for v in votes}
            voters = got[-1]["matched"] if -1 in got else 0.0
            nodes = []
            for node, v in got.items():
                enough = max(MIN_VOTERS, CONSTANT_SHARE * voters) if page.inside[node] else MIN_VOTERS
                if node >= 0 and v["matched"] >= enough - 1e-9 and v["same"] >= CONSTANT_SHARE * v["matched"]:
                    nodes.append(node)
            out.append((host, ref, source, nodes))
        yield pd.DataFrame(out, columns=["host", "ref", "ref_html", "template"])


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo = _Refs()
    for f in frames:
        texts = []
        for source, known, template in zip(f["html"], f["ref_html"], f["template"], strict=True):
            if not source:
                texts.append("")
            elif known is None:
                texts.append(main_text(Page(source), {}, set()))
            else:
                page = Page(source)
                texts.append(main_text(page, memo.align(page, memo[known]), set(template)))
        yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": texts})


def _joined(rows: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join; the side is broadcast only if its measured size allows it."""
    texts = [c for c, t in side.dtypes if t == "string"]
    size = side.agg(F.sum(sum((F.octet_length(c) for c in texts), F.lit(16)))).first()[0] or 0
    return rows.join(F.broadcast(side) if size <= BROADCAST_BYTES else side, on, how)


def _with_ref(rows: DataFrame, others: DataFrame) -> DataFrame:
    """``ref``, the layout whose reference a page is aligned with: its own, or the one named in ``others``."""
    rows = rows.withColumn("layout", _layout_udf()("html"))
    return _joined(rows, others, ["host", "layout"]).withColumn("ref", F.coalesce("ref", "layout"))


def induce(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Wrappers (host, ref, ref_html, template), and the layouts that take another's (host, layout, ref)."""
    rows = pages.select(_host(F.col("url")).alias("host"), "html").where(F.length("html") > 0)
    rows = rows.withColumn("h", F.xxhash64("html"))
    layouts = materialize(
        rows.select("host", _layout_udf()("html").alias("layout"), "h")
        .groupBy("host", "layout").agg(F.count(F.lit(1)).alias("pages"), F.min("h").alias("h")), "page-layouts")
    by_pages = Window.partitionBy("host").orderBy(F.desc("pages"), "layout")
    largest = materialize(
        layouts.withColumn("rank", F.row_number().over(by_pages)).where(F.col("rank") <= CANDIDATES)
        .where((F.col("pages") > MIN_VOTERS) | (F.col("rank") == 1)), "page-largest")
    # A host whose pages all differ in layout has the most frequent one as its reference.
    few = layouts.where(F.col("pages") <= MIN_VOTERS)
    first = largest.where(F.col("pages") <= MIN_VOTERS).select("host", "layout", "h")
    known = largest.groupBy("host").agg(F.collect_list("layout").alias("known"))
    others = materialize(
        few.join(first, ["host", "layout"], "left_anti").join(known, "host").select("host", "layout", "known")
        .mapInPandas(_similar, "host string, layout string, ref string"), "page-other-layouts")
    chosen = materialize(
        layouts.where(F.col("pages") > MIN_VOTERS).select("host", "layout", "h").unionByName(first)
        .withColumnRenamed("layout", "ref"), "page-chosen")
    refs = materialize(
        _joined(rows, chosen, ["host", "h"], "inner").groupBy("host", "ref").agg(F.min("html").alias("ref_html")),
        "page-refs")
    equal = materialize(rows.groupBy("h").count().where("count > 1"), "page-equal")
    votes = _counted(materialize(
        _joined(_with_ref(rows, others), refs, ["host", "ref"], "inner")
        .select("host", "ref", "html", "h", "ref_html").mapInPandas(_votes, _VOTES), "page-votes"), equal)
    wrappers = materialize(
        refs.join(votes, ["host", "ref"]).select("host", "ref", "ref_html", "votes")
        .mapInPandas(_templates, "host string, ref string, ref_html string, template array<int>")
        .where(F.size("template") > 0), "page-wrappers")
    return wrappers, others


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html")
    wrappers, others = induce(rows)
    rows = _with_ref(rows.withColumn("host", _host(F.col("url"))), others)
    page_id = rows.schema["page_id"].dataType.simpleString()
    return _joined(rows, wrappers, ["host", "ref"]).select("page_id", "url", "html", "ref_html", "template").mapInPandas(
        _extract, f"page_id {page_id}, url string, text string")
