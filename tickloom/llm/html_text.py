"""Main text of web pages by wrapper induction over pages of one host.

A page becomes a tree of containers; runs of equal leaf blocks (paragraphs, list items) fold into
one node, so a tree is as small as its layout. The host's page with the smallest id is its
reference, and every page of the host is aligned with it by simple tree matching: equal labels match,
and the children of matching nodes are matched in order so that the most nodes match.

Over all pages of a host, each node of the reference gathers how many pages match it, how much text
they hold there, and how often the text is the reference's own. Nodes with constant text are template where they stand
outside the content slot, which is the deepest container that holds nearly all varying text with the article or main
element around it, and outside other containers that hold varying text. A page's text is all its text in
page order without template, menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments. What does not align with the reference, or has too few pages to tell, is kept.

Element names mark menus, footers, forms and the like. Words in class, id and role mark parts of a page outside its article. Inside
an article element they decide nothing by themselves: headings, paragraphs and other leaves stay, and a container goes only
if its structure agrees (mostly links, form controls, an advert without a heading, reader comments that are named so or stand last)
or if all its text is the same on the host's pages. An id by itself decides nothing beside the page's heading either.

Trees are walked without recursion. Shapes of subtrees are numbered, equal shapes match as a whole and equal ends of two child
lists match first, so pages of one layout align in linear time. What is left of two lists is matched exactly at any length, row by row
of a table of which only every so many rows are held; pairs of subtrees are weighed once for each two shapes.

Counts are summed within a batch, then per host and node, so a host may hold most pages. The reference of
each host travels to its pages by a join that is broadcast only while small.

Cases: null and empty html have empty text; broken markup is read leniently (a block closes an
open paragraph, end tags without a start are skipped, what is open at the end is closed); text that
stands beside blocks is a block; a null URL counts as one host; the reference of a host whose ids are null is
its smallest page by digest; pages equal to the reference, or with its longest run of text, say nothing about constancy; repeated pages are read alike; an
empty table gives an empty result. No text is cut.
"""

from __future__ import annotations

import json
import re
from html import unescape
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.url_filter import host_and_path
from tickloom.sources.shared import written_once

#: Share of a host's varying text that the content slot holds, and of pages with equal text at a constant node.
SLOT_SHARE = 0.9
CONSTANT_SHARE = 0.9
#: A node is constant only if so many pages besides the reference have it.
CONSTANT_PAGES = 5
#: References are broadcast up to so many bytes in all.
BROADCAST_BYTES = 32 << 20

#: Element names and the words in class, id and role that mark parts which are not content.
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption tr address summary".split())
CONTAINERS = frozenset(
    "html body div article section main ul ol dl table tbody thead tfoot figure details center td th "
    "nav header footer aside form fieldset dialog head menu".split())
NOISE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe button select option textarea svg canvas "
    "object dialog menu title xmp label".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notification alert newsletter subscribe subscription sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs footer contentinfo complementary comment comments respond disqus replies share "
    "sharing social related recommended popup modal overlay login signup search skip masthead widget toast paywall "
    "discussion responses feedback".split())
#: Beginnings and endings of run-together names, names of whole pages, and words that only say what a part has.
NOISE_STARTS = ("cookie", "advert", "sidebar", "sponsor", "newsletter", "breadcrumb", "commentlist", "commentbox", "subscri")
NOISE_ENDS = ("navbar", "sidenav", "topnav", "sidebar", "footer", "adbox", "adslot", "cookiebar")
WHOLE = frozenset(("html", "body", "main"))
COMMENT_WORDS = frozenset("comment comments respond disqus replies discussion responses commentlist commentbox".split())
HAVING = frozenset(("has", "with", "no", "without", "hide", "show"))

#: Words of adverts and of reader comments that need little more evidence inside an article.
ADVERT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising".split())
COMMENTS = frozenset("comments commentlist commentbox disqus respond replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTROLS = frozenset("form input button select textarea".split())
#: Share of a container's text in links that makes it a menu.
LINK_SHARE = 0.5
#: Least rows of a table of two child lists that are held together; longer tables hold the root of their rows.
TABLE_ROWS = 64
#: Rows of fewer cells are lists, longer ones arrays; their numbers are the same.
SHORT = 24

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_FILED = re.compile(r"(?<!\S)(?:tag|category)-\S*")


class Node:
    """A container, or a leaf block (``text`` parts, no containers below unless it was broken)."""

    __slots__ = ("tag", "label", "noise", "named", "suspect", "article", "linked", "controls", "items")

    def __init__(self, tag: str, label: str, noise: bool, named: frozenset = frozenset()):
        #: Words that made it noise, if only they did, or for which it is a suspect.
        self.tag, self.label, self.noise, self.named = tag, label, noise, named
        self.suspect = self.article = False
        #: Characters of its own text in links, and form controls in it.
        self.linked = self.controls = 0
        self.items: list[Node | str] = []


def _is_noise(name: str, words: set[str]) -> bool:
    """Whether class, id or role mark a part as something else than content."""
    if not words or name in WHOLE or not words.isdisjoint(HAVING):
        return False
    return not words.isdisjoint(NOISE_WORDS) or any(
        w.startswith(NOISE_STARTS) or w.endswith(NOISE_ENDS) for w in words)


def _tags(html: str):
    """(start, end, closing, name, attributes) of each tag; name is None for comments and declarations.

    A tag that is not closed is text. Quotes that lead to no end are remembered, so no part is scanned for an end again.
    """
    last = {c: html.rfind(c) for c in "\"'>"}
    dead: set[int] = set()

    def closed(at: int) -> int:
        opened = []
        while at <= last[">"]:
            edge = _EDGE.search(html, at)
            if edge is None or edge.start() in dead:
                break
            if edge[0] == ">":
                return edge.start()
            opened.append(edge.start())
            if last[edge[0]] <= edge.start():
                break
            at = html.index(edge[0], edge.end()) + 1
        dead.update(opened)
        return -1

    at = html.find("<")
    while 0 <= at <= last[">"] or at >= 0 and html.startswith("<!--", at):
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            at = (yield at, end, "", None, "") or end
        elif html.startswith(("<!", "<?"), at):
            end = html.index(">", at) + 1
            at = (yield at, end, "", None, "") or end
        else:
            name = _NAME.match(html, at + 1)
            end = closed(name.end()) if name else -1
            if end >= 0:
                at = (yield at, end + 1, name[1], name[2].lower(), html[name.end():end]) or end + 1
            else:
                at += 1
        at = html.find("<", at)


def _postorder(root: Node) -> list[Node]:
    """All nodes, each after those below it."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [i for i in node.items if not isinstance(i, str)]
    return order[::-1]


def _give_back(root: Node) -> None:
    """Containers that words made noise are content if they hold most of the page's text.

    An advert or a row of comments may be longer than the article, so the page's heading or article has to be inside,
    or (but for comments and what is called an advert) nowhere else.
    """
    held: dict[int, int] = {}
    #: Tags below a node, and those not below noise.
    heads: dict[int, set[str]] = {}
    clear: dict[int, set[str]] = {}
    wanted = frozenset(("h1", "main", "article"))
    none: set[str] = set()
    for n in _postorder(root):
        below = [i for i in n.items if not isinstance(i, str)]
        held[id(n)] = sum(len(i.strip()) for i in n.items if isinstance(i, str)) + sum(
            held[id(i)] for i in below if i.named or not i.noise)
        for found, some in ((heads, below), (clear, [i for i in below if not i.noise])):
            inner = none.union(*(found[id(i)] for i in some), wanted.intersection(i.tag for i in some))
            found[id(n)] = inner or none
    at, whole = root, held[id(root)]
    while at is not None:
        at = next((i for i in at.items if isinstance(i, Node) and 2 * held[id(i)] > whole), None)
        if at is not None and at.noise and at.named:
            comments = not at.named.isdisjoint(COMMENT_WORDS)
            inside = heads[id(at)] & ({"h1", "main"} if comments else wanted)
            advert = not at.named.isdisjoint(ADVERTS)
            if at.tag not in CONTAINERS or not inside and (comments or advert or clear[id(root)]):
                return
            at.noise, at.named = False, frozenset()


def _judge(root: Node, suspects: list[Node]) -> None:
    """Suspects whose structure agrees with their words are noise."""
    text: dict[int, int] = {}
    linked: dict[int, int] = {}
    #: Headings, form controls, articles, comments below.
    marks: dict[int, list[int]] = {}
    for n in _postorder(root):
        below = [i for i in n.items if not isinstance(i, str)]
        text[id(n)] = sum(len(i.strip()) for i in n.items if isinstance(i, str)) + sum(text[id(i)] for i in below)
        linked[id(n)] = n.linked + sum(linked[id(i)] for i in below)
        own = [n.tag in HEADINGS, n.controls, n.tag == "article", "comment" in n.label]
        marks[id(n)] = [own[k] + sum(marks[id(i)][k] for i in below) for k in range(4)]
    chosen = {id(n) for n in suspects}
    # Suspects after which nothing but suspects and noise follows where they stand.
    lasting = set()
    for n in _postorder(root):
        for item in reversed(n.items):
            if isinstance(item, str) and item.strip() or isinstance(item, Node) and not item.noise and id(item) not in chosen:
                break
            if isinstance(item, Node) and id(item) in chosen:
                lasting.add(id(item))
    for n in suspects:
        headings, controls, articles, comments = marks[id(n)]
        is_advert = not n.named.isdisjoint(ADVERT_WORDS) and not headings
        is_menu = linked[id(n)] >= LINK_SHARE * max(1, text[id(n)])
        is_comments = not n.named.isdisjoint(COMMENT_WORDS) and (articles or comments > 1) or (
            not n.named.isdisjoint(COMMENTS) and id(n) in lasting)
        # Words of an id alone do not make comments or adverts.
        own = n.suspect and (is_advert or is_comments)
        n.noise = own or is_menu or bool(controls)
        n.suspect = not n.noise


def parse(html: str) -> Node:
    """The tree of blocks of a page; items are nodes and pieces of text in page order."""
    root = Node("html", "html", False)
    stack, at, end = [root], 0, len(html)
    open_tags = {"html": 1}
    #: Article elements, containers beside whose heading we are, and noise around the place.
    inside = {"article": 0, "heading": 0, "noise": 0}
    named_any, suspects, in_link = False, [], False

    def push(node: Node) -> None:
        stack.append(node)
        open_tags[node.tag] = open_tags.get(node.tag, 0) + 1
        inside["article"] += node.tag == "article"
        inside["noise"] += node.noise

    def pop() -> None:
        node = stack.pop()
        open_tags[node.tag] -= 1
        inside["article"] -= node.tag == "article"
        inside["heading"] -= node.article
        inside["noise"] -= node.noise

    def add(text: str) -> None:
        stack[-1].items.append(text)
        if in_link:
            stack[-1].linked += len(text.strip())

    tags = _tags(html)
    skip = None
    while True:
        try:
            start, stop, closing, name, attributes = tags.send(skip)
        except StopIteration:
            break
        skip = None
        if start > at:
            add(html[at:start])
        at = stop
        if name is None:
            continue
        if name == "a":
            in_link = not closing
        if closing:
            # End tags of what is not open, such as those of inline elements, are skipped.
            if open_tags.get(name, 0) and name != "html":
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == name:
                        while len(stack) > depth:
                            pop()
                        break
                    if stack[depth].tag in CONTAINERS and name not in CONTAINERS:
                        break
            continue
        if name in CONTROLS:
            stack[-1].controls += 1
        if name == "br":
            add(" ")
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(f"</{name}\\s*>", re.I).search(html, at)
            at = skip = close.end() if close else end
            continue
        block = name in LEAVES or name in CONTAINERS
        marks = {"class": "", "role": "", "id": ""}
        for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
            marks[m[1].lower()] += " " + next(filter(None, m.groups()[1:]), "")
        words = set(_WORD.findall(" ".join(marks.values()).lower()))
        noise = name in NOISE_TAGS or (not inside["article"] and name == "header")
        named, suspect, by_class = frozenset(), False, False
        # Words never decide on headings, on an article that stands by itself, nor words of tags and categories on any part.
        if not noise and words and name not in HEADINGS and (name != "article" or inside["article"]):
            said = set(_WORD.findall(_FILED.sub(" ", (marks["class"] + marks["role"]).lower())))
            every = said | set(_WORD.findall(_FILED.sub(" ", marks["id"].lower())))
            by_class = _is_noise(name, said)
            if inside["article"]:
                suspect = name in CONTAINERS and _is_noise(name, every)
            elif by_class or "header" in every and name in CONTAINERS and name not in WHOLE:
                noise = True
            elif name in CONTAINERS and _is_noise(name, every):
                suspect = inside["heading"] > 0
                noise = not suspect
            if noise or suspect:
                named = frozenset(every)
            named_any |= noise
        if not block and not noise:
            continue
        if block:
            # A block ends an open paragraph or heading; a list item ends the item before it.
            while len(stack) > 1 and stack[-1].tag not in CONTAINERS and not stack[-1].noise and (
                    stack[-1].tag not in ("li", "dd", "dt", "blockquote", "tr") or name in ("li", "dd", "dt", "tr")):
                pop()
        if name == "html" or name == "body" and open_tags.get("body", 0):
            continue
        node = Node(name, name + "." + ".".join(sorted(words)), noise, named)
        if suspect:
            node.suspect = by_class
            suspects.append(node)
        beside = stack[-1]
        if name == "h1" and not inside["article"] and not inside["noise"] and not beside.article and (
                beside.tag in CONTAINERS and beside.tag not in ("html", "body")):
            beside.article = True
            inside["heading"] += 1
        beside.items.append(node)
        if not attributes.endswith("/") or block:
            push(node)
    if at < end:
        add(html[at:])
    if suspects:
        _judge(root, suspects)
    if named_any:
        _give_back(root)
    return root


def _clean(pieces: list[str]) -> str:
    return " ".join(unescape("".join(pieces)).split())


def blocks(node: Node, dropped: frozenset = frozenset()) -> list[str]:
    """Texts of the blocks under a node in page order, without noise and the nodes in ``dropped``.

    Of a dropped container the blocks and containers in it stay.
    """
    found, open_text = [], []

    def flush():
        text = _clean(open_text)
        if text:
            found.append(text)
        open_text.clear()

    stack = [(node, iter(node.items))]
    while stack:
        n, items = stack[-1]
        for item in items:
            if isinstance(item, str):
                if id(n) not in dropped:
                    open_text.append(item)
            elif item.noise or id(item) in dropped and item.tag not in CONTAINERS:
                if item.tag in LEAVES or item.tag in CONTAINERS:
                    flush()
            else:
                flush()
                stack.append((item, iter(item.items)))
                break
        else:
            flush()
            stack.pop()
    return found


class Folded:
    """Skeleton node: a container, or a run of equal leaf blocks."""

    __slots__ = ("label", "nodes", "children", "number", "parent", "shape", "size")

    def __init__(self, label: str, nodes: list[Node], parent: Folded | None):
        self.label, self.nodes, self.parent = label, nodes, parent
        self.children: list[Folded] = []
        self.number = -1
        #: Number of its subtree's shape, alike for equal ones, and its nodes.
        self.shape, self.size = -1, 1

    @property
    def container(self) -> bool:
        return self.nodes[0].tag in CONTAINERS


#: Shapes of subtrees met in a batch: (label, shapes of the children) to a number.
Shapes = dict[tuple, int]


def fold(root: Node, shapes: Shapes | None = None) -> list[Folded]:
    """Skeleton nodes of a tree in page order, the root first. Noise is left out, with all below it.

    Trees that are aligned share ``shapes``.
    """
    shapes = {} if shapes is None else shapes
    order: list[Folded] = []

    def make(node: Node, parent: Folded | None) -> Folded:
        own = Folded(node.label, [node], parent)
        own.number = len(order)
        order.append(own)
        if parent is not None:
            parent.children.append(own)
        return own

    top = make(root, None)
    stack = [(top, iter(root.items))]
    while stack:
        own, items = stack[-1]
        for item in items:
            if isinstance(item, str) or item.noise:
                continue
            last = own.children[-1] if own.children else None
            if item.tag in CONTAINERS:
                stack.append((make(item, own), iter(item.items)))
                break
            if last is not None and not last.container and last.label == item.label:
                last.nodes.append(item)
            else:
                make(item, own)
        else:
            stack.pop()
    for f in reversed(order):
        f.size = 1 + sum(c.size for c in f.children)
        f.shape = shapes.setdefault((f.label, tuple(c.shape for c in f.children)), len(shapes))
    return order


def _ends(a: list[Folded], b: list[Folded]) -> tuple[int, int]:
    """How many children of two lists have equal shapes from the start, and from the end of what is left."""
    most = min(len(a), len(b))
    first = next((i for i in range(most) if a[i].shape != b[i].shape), most)
    most -= first
    last = next((i for i in range(most) if a[-1 - i].shape != b[-1 - i].shape), most)
    return first, last


def _matched(a: list[Folded], b: list[Folded], memo: dict) -> list[tuple[Folded, Folded]]:
    """Pairs of two lists, in order, of the greatest weight."""
    first, last = _ends(a, b)
    pairs = list(zip(a[:first], b[:first])) + list(zip(a[len(a) - last:], b[len(b) - last:]))
    return pairs + _best(a[first:len(a) - last], b[first:len(b) - last], memo)


def _best(a: list[Folded], b: list[Folded], memo: dict) -> list[tuple[Folded, Folded]]:
    """``_matched`` without equal ends; of equal weights the pairs that stand first."""
    if not a or not b:
        return []
    if len(a) == 1 or len(b) == 1:
        pair = max(((u, v) for u in a for v in b), key=lambda p: _weight(*p, memo))
        return [pair] if _weight(*pair, memo) else []
    n, shapes = len(a), {v.shape: v for v in b}
    number = {shape: k for k, shape in enumerate(shapes)}
    place = [number[v.shape] for v in b]
    gains = {u.shape: [_weight(u, v, memo) for v in shapes.values()] for u in {u.shape: u for u in a}.values()}
    if len(b) >= SHORT:
        place = np.array(place)
        gains = {shape: np.array(found, np.int32) for shape, found in gains.items()}

    def fill(above, low: int, high: int):
        """Rows of the table from the one above them; the same numbers in lists if they are short, in arrays else."""
        if len(b) < SHORT:
            rows = [above]
            for u in a[low:high]:
                gain, before, row, left = gains[u.shape], rows[-1], [0], 0
                for k, at in enumerate(place):
                    left = max(before[k] + gain[at], before[k + 1], left)
                    row.append(left)
                rows.append(row)
            return rows
        rows = np.zeros((high - low + 1, len(b) + 1), np.int32)
        rows[0] = above
        for k in range(high - low):
            row = rows[k + 1]
            np.add(rows[k, :-1], gains[a[low + k].shape].take(place), out=row[1:])
            np.maximum(row, rows[k], out=row)
            np.maximum.accumulate(row, out=row)
        return rows

    step = max(TABLE_ROWS, isqrt(n))
    tops = [[0] * (len(b) + 1)]
    for low in range(0, n - step, step):
        tops.append(fill(tops[-1], low, low + step)[-1][:])
    found, j = [], len(b)
    for k in reversed(range(len(tops))):
        low, i = k * step, min(n, (k + 1) * step)
        rows = fill(tops[k], low, i)
        while i > low and j > 0:
            here = rows[i - low][j]
            if here == rows[i - low - 1][j]:
                i -= 1
            elif here == rows[i - low][j - 1]:
                j -= 1
            else:
                found.append((a[i - 1], b[j - 1]))
                i, j = i - 1, j - 1
    return found


def align(a: Folded, b: Folded, pairs: dict[int, Folded], memo: dict) -> None:
    """Simple tree matching: fill ``pairs`` with b's partner of each matched node of a, by number."""
    if a.label != b.label:
        return
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        pairs[x.number] = y
        if x.shape == y.shape:
            stack += zip(x.children, y.children)
        else:
            _weigh(x, y, memo)
            stack += _matched(x.children, y.children, memo)


def _weight(a: Folded, b: Folded, memo: dict) -> int:
    """Nodes of the largest matching of two trees; known for the children of a pair that is weighed."""
    if a.label != b.label:
        return 0
    if a.shape == b.shape:
        return a.size
    if not a.children or not b.children:
        return 1
    return memo[a.shape, b.shape]


def _weigh(a: Folded, b: Folded, memo: dict) -> None:
    """Put the weight of a pair of trees in ``memo``, and those of all pairs below that it rests on."""
    stack = [(a, b, False)]
    while stack:
        x, y, ready = stack.pop()
        key = (x.shape, y.shape)
        if key in memo:
            continue
        if not ready:
            stack.append((x, y, True))
            first, last = _ends(x.children, y.children)
            left, right = x.children[first:len(x.children) - last], y.children[first:len(y.children) - last]
            by_label: dict[str, list[Folded]] = {}
            for v in {v.shape: v for v in right if v.children}.values():
                by_label.setdefault(v.label, []).append(v)
            for u in {u.shape: u for u in left if u.children}.values():
                stack += [(u, v, False) for v in by_label.get(u.label, ()) if u.shape != v.shape and (u.shape, v.shape) not in memo]
        else:
            memo[key] = 1 + sum(_weight(u, v, memo) for u, v in _matched(x.children, y.children, memo))


def _texts(folded: list[Folded]) -> list[str]:
    """Text of each node: of a run its blocks, of a container the text that stands beside its blocks."""
    found = []
    for f in folded:
        if f.container:
            found.append(_clean([i for i in f.nodes[0].items if isinstance(i, str)]))
        else:
            found.append("\n".join(t for n in f.nodes for t in blocks(n)))
    return found


def slot_of(folded: list[Folded], mass: list[float]) -> int:
    """Number of the deepest container that holds ``SLOT_SHARE`` of the text."""
    total = list(mass)
    for f in reversed(folded):
        if f.parent is not None:
            total[f.parent.number] += total[f.number]
    at = folded[0]
    while True:
        inner = [c for c in at.children if c.container and total[c.number] >= SLOT_SHARE * total[0]]
        if not inner or total[0] <= 0:
            return at.number
        at = max(inner, key=lambda c: total[c.number])


def template_of(folded: list[Folded], mass: list[float], constant: frozenset) -> list[int]:
    """Constant nodes that are no part of the content: neither in the slot nor beside varying text in a container."""
    slot = folded[slot_of(folded, mass)]
    around = [slot]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    # The slot grows to the outermost article around it, else to the outermost main element.
    for tag in ("article", "main"):
        whole = [f for f in around if f.nodes[0].tag == tag]
        if whole:
            slot = whole[-1]
            break
    varied = list(mass)
    for f in reversed(folded):
        if f.parent is not None:
            varied[f.parent.number] += varied[f.number]
    path, inside = {f.number for f in around[around.index(slot):]}, set()
    if slot.nodes[0].tag in ("html", "body"):
        # A whole page has template beside its content: what stands between varying parts is content.
        varying = [i for i, c in enumerate(slot.children) if varied[c.number] > 0]
        if varying:
            inside = {c.number for c in slot.children[varying[0]:varying[-1]]}
    else:
        path.discard(slot.number)
    # Where each node's question is settled: at itself, or at what the node around it has.
    settled: list[Folded] = []
    doubted = [False] * len(folded)
    for f in folded:
        stops = f.number in path or f is slot or f.number in inside or varied[f.number] > 0
        settled.append(f if stops or f.parent is None else settled[f.parent.number])
        doubted[f.number] = f.nodes[0].suspect and varied[f.number] == 0 or f.parent is not None and doubted[f.parent.number]
    found = []
    for number in sorted(constant):
        at = folded[number]
        if not at.container and number not in inside:
            at = at.parent
        # Words that name a part of an article as something else are right where its text is the same on all pages.
        if settled[at.number].number in path or doubted[number]:
            found.append(number)
    return found


def main_text(html: str, reference: list[Folded], template: frozenset, shapes: Shapes) -> str:
    if not template:
        return "\n".join(blocks(parse(html)))
    folded = fold(parse(html), shapes)
    pairs: dict[int, Folded] = {}
    align(reference[0], folded[0], pairs, {})
    dropped = frozenset(id(n) for c in template if c in pairs for n in pairs[c].nodes)
    return "\n".join(blocks(folded[0].nodes[0], dropped))


class _References:
    """Skeletons of the references a task has met last, and the shapes they and their pages share."""

    def __init__(self):
        self.known: dict[str, list[Folded]] = {}
        self.shapes: Shapes = {}

    def __call__(self, html: str) -> list[Folded]:
        if html not in self.known:
            if len(self.known) >= 256 or len(self.shapes) > 1 << 18:
                self.known, self.shapes = {}, {}
            self.known[html] = fold(parse(html), self.shapes)
        return self.known[html]


def _longest(folded: list[Folded], texts: list[str]) -> int:
    """Number of the node with the longest text, of those in an article or main element if these hold any."""
    inside = [False] * len(folded)
    for f in folded:
        inside[f.number] = f.nodes[0].tag in ("article", "main") or f.parent is not None and inside[f.parent.number]
    return max(range(len(folded)), key=lambda n: (inside[n] and bool(texts[n]), len(texts[n])))


def _observe(batches):
    """Per host and reference node: pages matched, those that differ from the reference, text held, equal texts."""
    references, texts = _References(), {}
    for batch in batches:
        counts: dict[tuple[str, int], list[int]] = {}
        columns = (batch.column(n).to_pylist() for n in ("host", "html", "reference"))
        for host, html, reference in zip(*columns):
            known = references(reference)
            if id(known) not in texts:
                texts.clear()
                texts[id(known)] = _texts(known)
            own = texts[id(known)]
            folded = fold(parse(html), references.shapes)
            pairs: dict[int, Folded] = {}
            align(known[0], folded[0], pairs, {})
            found = _texts(folded)
            # A copy of the reference's article says nothing about what pages share.
            main = _longest(known, own)
            copy = main in pairs and own[main] != "" and found[pairs[main].number] == own[main]
            other = html != reference and not copy
            for number, match in pairs.items():
                c = counts.setdefault((host, number), [0, 0, 0])
                text = found[match.number]
                c[0] += other
                c[1] += len(text)
                c[2] += other and bool(text) and text == own[number]
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
            *(pa.array([counts[k][i] for k in keys], pa.int64()) for i in range(3)),
        ], ["host", "node", "pages", "chars", "same"])


def _induce(batches):
    """Template nodes of each host, from its reference and its nodes' counts."""
    for batch in batches:
        templates = []
        for reference, nodes in zip(batch.column("reference").to_pylist(), batch.column("nodes").to_pylist()):
            folded = fold(parse(reference))
            mass, constant = [0.0] * len(folded), []
            for c in nodes:
                if c["pages"] >= CONSTANT_PAGES and c["same"] >= CONSTANT_SHARE * c["pages"]:
                    constant.append(c["node"])
                else:
                    mass[c["node"]] = c["chars"]
            templates.append(json.dumps(template_of(folded, mass, frozenset(constant))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("reference"), pa.array(templates, pa.string())],
            ["host", "reference", "template"])


def _extract(batches):
    references = _References()
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("html", "reference", "template"))
        texts = [
            main_text(html, references(reference), frozenset(json.loads(template)), references.shapes)
            for html, reference, template in zip(*columns)
        ]
        kept = [n for n in batch.schema.names if n not in ("html", "reference", "template")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(texts, pa.string())], [*kept, "text"])


def extract(pages: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, url, ``keep``, text, n_chars) of each page of (page_id, url, html)."""
    host, _ = host_and_path(F.col("url").cast("string"))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    given = pages.select("page_id", "url", *keep, host.alias("host"), html.alias("html"))
    first = F.struct("page_id", F.md5("html").alias("digest"))
    # One page for each host; null ids come last.
    leads = given.filter("page_id IS NOT NULL").groupBy("host").agg(F.min(first).alias("lead")).unionByName(
        given.filter("page_id IS NULL").groupBy("host").agg(F.min(first).alias("lead")))
    leads = leads.groupBy("host").agg(F.coalesce(
        F.min(F.when(F.col("lead.page_id").isNotNull(), F.col("lead"))), F.min("lead")).alias("lead"))
    leads = written_once(leads.select(F.col("host").alias("_host"), "lead.*"), "leads")
    references = given.join(
        leads.withColumnRenamed("page_id", "_lead"),
        (F.col("host") == F.col("_host")) & F.col("page_id").eqNullSafe(F.col("_lead")) &
        (F.md5("html") == F.col("digest")),
    ).select("host", F.col("html").alias("reference")).dropDuplicates(["host"])
    references = written_once(references, "references")

    def small(table: DataFrame) -> DataFrame:
        held = table.agg(F.sum(F.length("reference") + F.length("host") + 100)).first()[0] or 0
        return F.broadcast(table) if held <= BROADCAST_BYTES else table

    observed = given.select("host", "html").join(small(references), "host").mapInArrow(
        _observe, "host string, node int, pages bigint, chars bigint, same bigint")
    nodes = observed.groupBy("host", "node").agg(*(F.sum(n).alias(n) for n in ("pages", "chars", "same")))
    # As many nodes as the reference's layout has.
    by_host = nodes.groupBy("host").agg(F.collect_list(F.struct("node", "pages", "chars", "same")).alias("nodes"))
    wrappers = written_once(references.join(by_host, "host").select("host", "reference", "nodes").mapInArrow(
        _induce, "host string, reference string, template string"), "wrappers")
    joined = given.join(small(wrappers), "host").select(
        "page_id", "url", *keep, "html", "reference", "template")
    kept = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, "
        for f in joined.drop("html", "reference", "template").schema)
    texts = joined.mapInArrow(_extract, f"{kept}text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
