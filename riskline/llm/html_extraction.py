"""Main text of HTML pages by minimum-cut labelling (operator 6).

A page is read once into text blocks (runs of text between block-level tags) with their open elements. Each block is a
node. A classifier gives it two costs, which are its capacities to the two terminals: labelling it boilerplate costs its
evidence for content and the other way round (landmark elements, class and id words, article or main element, words,
link share). Blocks that follow each other, and blocks of one parent element, are joined by smoothness edges. The
minimum cut (augmenting paths) separates content from boilerplate; the content blocks are the text.

Class and id words mark all that is in an element, but not if it is a wrapper of the page: one that holds every article and main
element (every h1, on a page without them) and most of the text. A title (h1) in an article is not marked by the words of what is around it.

Pages stay in their partitions; nothing is shuffled. A page of any length is read whole; work is linear in
its length but for the flow, which is short-range. Null and empty pages, and pages without text, give an empty text. Repeated rows
and ids each give their row. Tags that are cut off or never closed are taken as far as they go.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*)>?|<[!?][^>]*>?""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-label)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

# HTML element names by their part in a page.
RAW = {"script", "style", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "title", "textarea", "svg", "math", "object", "canvas", "audio", "video"}
#: Those of them that HTML reads as text up to their end tag, or to the end of the page.
TEXT_ONLY = {"script", "style", "iframe", "noembed", "noframes", "xmp", "title", "textarea"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "label", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
LANDMARK = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "select", "button", "head", "fieldset", "search", "label"}
#: Elements that end an open one of the first kind, and where the search for it stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words of class, id and role attributes that mark boilerplate.
MARKS = {
    "ad", "ads", "adsbygoogle", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "discussion", "disqus", "footer", "form",
    "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager",
    "pagination", "popup", "privacy", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "search", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toc", "toolbar", "widget",
}
#: Elements whose class words say nothing about the text in them.
ROOTS = {"html", "body", "main", "article"}

#: Capacities: a marked block, one inside or outside the article element, and the smoothness edges (to the
#: next block; to the next of the same parent; 1 between a marked block and one that is not).
MARKED, INSIDE, OUTSIDE, NEXT, SIBLING = 60, 30, 30, 3, 4


class Block:
    __slots__ = ("text", "linked", "marked", "article", "parent", "tag", "near")

    def __init__(self, text: str, linked: int, marked: bool, article: bool, parent: int, tag: str, near: int):
        self.text, self.linked, self.marked, self.article, self.parent, self.tag, self.near = text, linked, marked, article, parent, tag, near


def marks(attributes: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether words of its class, id or role say that it is boilerplate."""
    words = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden":
            return True, words
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return True, words
        elif any(w.lower() in MARKS for w in _WORD.findall(value)) or any(w in MARKS for w in re.split(r"[^a-z]+", value.lower())):
            words = True
    return False, words


def mark_by_words(blocks: list[Block], outer: dict[int, int], anchors: list[int]) -> None:
    """Marks the blocks in elements with boilerplate words, but for wrappers. ``outer``: the next such element around each (0: none), by
    number, so that outer ones come first; ``anchors``: the innermost of them around each article and main element (or h1)."""
    text, held = Counter[int](), Counter(anchors)
    for b in blocks:
        if not b.marked:
            text[b.near] += len(b.text)
    whole = text.total()
    for number, around in reversed(outer.items()):
        if around:
            text[around] += text[number]
            held[around] += held[number]
    bad = {0: False}
    for number, around in outer.items():
        wrapper = anchors and held[number] == len(anchors) and 2 * text[number] > whole
        bad[number] = bad[around] or not wrapper
    for b in blocks:
        b.marked |= bad[b.near] and not (b.article and b.tag == "h1")


def blocks_of(html: str) -> tuple[list[Block], bool]:
    """The text blocks of a page in order, and whether it has an article or main element."""
    # tag, marked by a tag or hidden, in article, number, in a link, innermost element with boilerplate words
    stack: list[tuple[str, bool, bool, int, bool, int]] = [("", False, False, 0, False, 0)]
    outer: dict[int, int] = {}
    articles: list[int] = []
    titles: list[int] = []
    opened: Counter[str] = Counter()  # open elements by name: an end tag without any is passed over at once
    out: list[Block] = []
    run: list[str] = []
    linked, number, has_article, at, end = 0, 0, False, 0, len(html)
    endless: set[str] = set()  # elements without any further end tag, of which only the start tag is passed over

    def add(text: str) -> None:
        nonlocal linked
        if "&" in text:
            text = unescape(text)
        run.append(text)
        if stack[-1][4]:
            linked += len(text.strip())

    def close() -> None:
        nonlocal linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                place = len(stack) - 1
                while place and stack[place][0] not in BLOCK:
                    place -= 1
                tag, marked, article, own, _, _ = stack[place]
                parent = stack[place - 1][3] if place else own
                out.append(Block(text, linked, marked or stack[-1][1], article, parent, tag, stack[-1][5]))
            run.clear()
        linked = 0

    def leave(i: int) -> None:
        opened.subtract(x[0] for x in stack[i:])
        del stack[i:]

    while at < end:
        open_at = html.find("<", at)
        if open_at < 0:
            add(html[at:])
            break
        if open_at > at:
            add(html[at:open_at])
        m = _TAG.match(html, open_at)
        if m is None:
            add("<")
            at = open_at + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag
            if tag in BLOCK:
                close()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    leave(i)
                    break
                if stack[i][0] in BLOCK and tag not in BLOCK:
                    break
            continue
        if tag in RAW:
            if tag not in endless and not m[3].rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
                if stop is None and tag not in TEXT_ONLY:
                    endless.add(tag)
                else:
                    at = stop.end() if stop else end
            run.append(" ")
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in BLOCK:
            close()
            if opened["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        leave(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            if tag in ENDS:
                ended, limit = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in ended:
                        leave(i)
                        break
                    if stack[i][0] in limit:
                        break
        if tag in VOID:
            continue
        number += 1
        top = stack[-1]
        article = tag in ("article", "main")
        has_article |= article
        hidden, words = marks(m[3]) if tag not in ROOTS and m[3] and m[3] != "/" else (False, False)
        marked = top[1] or tag in LANDMARK or hidden
        near = top[5]
        if article or tag == "h1":
            (articles if article else titles).append(near)
        if words:
            outer[number] = near
            near = number
        if not m[3].endswith("/"):
            stack.append((tag, marked, top[2] or article, number, top[4] or tag == "a", near))
            opened[tag] += 1
    close()
    mark_by_words(out, outer, articles or titles)
    return out, has_article


def outside_cost(blocks: list[Block]) -> int:
    """What speaks against a block outside the article: less, the more of the page's unmarked text (but links) is there,
    as the element then holds teasers or only a part of the text."""
    inside = sum(len(b.text) - b.linked for b in blocks if not b.marked and b.article)
    outside = sum(len(b.text) - b.linked for b in blocks if not b.marked and not b.article)
    return OUTSIDE * inside // outside if outside > inside >= 0 else OUTSIDE


def costs(b: Block, has_article: bool, outside: int = OUTSIDE) -> tuple[int, int]:
    """(evidence for content, evidence for boilerplate)."""
    words = b.text.count(" ") + 1
    share = min(1.0, b.linked / max(1, len(b.text)))
    content, other = min(20, words), int(10 * share)
    if b.tag[:1] == "h" and b.tag[1:].isdigit():
        content += 5
    if b.text[-1] in ".!?…»\"'”’:;)":
        content += 4
    if b.marked:
        return content, other + MARKED
    if has_article and b.article:
        return content + INSIDE, other
    alone = int(20 * share) + (3 if words < 5 else 0)
    return content, other + (max(outside, alone) if has_article else alone)


def minimum_cut(net: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut. ``net``: capacity from the source less that to the
    sink; ``edges``: (node, node, capacity both ways). Augmenting paths, the shortest first; a region that cannot
    reach the sink any more is cut off for good."""
    n = len(net)
    near: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, c in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += [b, a]
        room += [c, c]
    left, source = list(net), [False] * n
    for u in range(n):
        while left[u] > 0 and not source[u]:
            came, queue, goal = {u: -1}, deque([u]), -1
            while queue and goal < 0:
                x = queue.popleft()
                for e in near[x]:
                    y = to[e]
                    if room[e] > 0 and y not in came and not source[y]:
                        came[y] = e
                        if left[y] < 0:
                            goal = y
                            break
                        queue.append(y)
            if goal < 0:
                for x in came:
                    source[x] = True
                break
            path, x = [], goal
            while x != u:
                path.append(came[x])
                x = to[came[x] ^ 1]
            flow = min(left[u], -left[goal], *(room[e] for e in path))
            for e in path:
                room[e] -= flow
                room[e ^ 1] += flow
            left[u] -= flow
            left[goal] += flow
    return source


def main_text(html: str) -> str:
    """The main text of a page: its content blocks, one per line."""
    found, has_article = blocks_of(html)
    if not found:
        return ""
    net, edges, last, outside = [], [], {}, outside_cost(found)
    for i, b in enumerate(found):
        content, other = costs(b, has_article, outside)
        net.append(content - other)
        if i:
            edges.append((i - 1, i, NEXT if found[i - 1].marked == b.marked else 1))
        if (b.parent, b.marked) in last:
            edges.append((last[b.parent, b.marked], i, SIBLING))
        last[b.parent, b.marked] = i
    return "\n".join(b.text for b, content in zip(found, minimum_cut(net, edges), strict=True) if content)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    pages = df.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
