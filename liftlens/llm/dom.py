"""A page as a tree of block elements with their text, and features of every node."""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter

TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)(?:((?:[^>"']|"[^"]*"|'[^']*')*+)>|([^>]*)(?:>|\Z)))""",
    re.S)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# formulas stand in the line
MATH = "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle semantics"
INLINE = frozenset(MATH.split()) | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
# never text of an article
NEVER = frozenset("head script style title textarea xmp iframe noembed noframes template svg annotation "
                  "annotation-xml audio video canvas select option button input datalist menu".split())
# an open element that a new one ends
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
        "body": {"head"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "tbody": {"table"}}
CLOSES_P = frozenset("address article aside blockquote div dl dd dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                     "li main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("tag", "parent", "children", "tokens", "hidden", "depth", "link", "chars", "link_chars", "links",
                 "tags", "words", "stops", "paragraphs", "own", "runs", "heading")

    def __init__(self, tag: str, parent: Node | None, tokens: tuple[str, ...] = (), hidden: bool = False):
        self.tag, self.parent, self.tokens, self.hidden = tag, parent, tokens, hidden
        self.children: list[Node] = []
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.link_chars = self.links = self.tags = self.words = self.stops = self.paragraphs = 0
        self.own = self.runs = 0
        self.heading = False


def _attributes(text: str) -> tuple[tuple[str, ...], bool]:
    """Words of the naming attributes, and whether the element is hidden."""
    tokens: list[str] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(text):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-component"):
            tokens += [t.lower() for t in TOKEN.findall(value)]
        elif name == "hidden":
            hidden = True
        elif name == "style" and "display" in value.lower() and re.search(r"display\s*:\s*none", value.lower()):
            hidden = True
    return tuple(tokens), hidden


_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """(nodes in page order, parents first; text runs in page order with their node).

    Adjacent runs of one block are one run: inline elements add no space, blocks and line
    breaks do.  Text of elements that never hold an article is dropped here.
    """
    root = Node("#root", None)
    nodes, texts = [root], []
    stack: list[Node] = [root]      # block elements
    open_at: dict[str, list[int]] = {}  # of every tag, where on the stack it is open
    links = 0                       # open <a>
    never = 0                       # open elements of NEVER
    parts: list[str] = []           # text since the last break
    linked = 0                      # characters of it inside links

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                node = stack[-1]
                texts.append((node, text))
                node.own += len(text)
                node.link_chars += min(linked, len(text))
                node.runs += 1
            parts.clear()
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal never
        flush()
        for node in reversed(stack[k:]):
            open_at[node.tag].pop()
            never -= node.tag in NEVER or node.hidden
        del stack[k:]

    at = 0
    while True:
        m = TAG.search(page, at)
        raw = page[at:m.start()] if m else page[at:]
        if raw and not never:
            raw = htmllib.unescape(raw) if "&" in raw else raw
            parts.append(raw)
            if links:
                linked += len(raw.strip())
        if not m:
            break
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name == "a":
                links = 0
            if name in INLINE:
                continue
            if name == "br":
                flush()
                continue
            if open_at.get(name):
                pop_to(open_at[name][-1])
            continue
        stack[-1].tags += 1
        if name == "a":
            links = 1
            stack[-1].links += 1
            continue
        if name in INLINE:
            continue
        attributes = m[3] if m[3] is not None else m[4] or ""
        if name in VOID:
            if name in ("br", "hr"):
                flush()
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            flush()
            at = end.start() if end else len(page)
            if end and (close := TAG.match(page, at)):
                at = close.end()
            continue
        flush()
        links = 0
        if name in CLOSES_P and stack[-1].tag == "p":
            pop_to(len(stack) - 1)
        if name in ENDS:
            def last(tags) -> int:
                return max((open_at[t][-1] for t in tags if open_at.get(t)), default=0)
            if (k := last(ENDS[name])) > last(SCOPES.get(name, ())):
                pop_to(k)
        tokens, hidden = _attributes(attributes) if attributes.strip(" /") else ((), False)
        node = Node(name, stack[-1], tokens, hidden)
        if name in NEVER or hidden:
            never += 1
        stack[-1].children.append(node)
        open_at.setdefault(name, []).append(len(stack))
        stack.append(node)
        nodes.append(node)
    flush()
    return nodes, texts


# ---- features ------------------------------------------------------------------------------------------------------

# Words of naming attributes by what they tell.
GROUPS = [set(x.split()) for x in (
    "article content post entry story body main text maincontent articlebody blog news prose page single hentry",
    "nav navigation menu menubar navbar breadcrumb breadcrumbs crumb pagination pager tabs toc topnav links sitemap",
    "ad ads adv advert advertisement advertising sponsor sponsored promo promotion promoted banner adsense dfp teaser outbrain",
    "comment comments commentlist disqus reply replies respond discussion feedback review reviews reader responses",
    "footer foot copyright legal bottom colophon imprint credits disclaimer",
    "header masthead top head branding logo hero topbar site",
    "sidebar side aside widget widgets rail related recommended recommendations popular trending more secondary tags",
    "cookie cookies consent gdpr notice alert popup modal overlay message privacy paywall warning toast announcement",
    "share social sharing follow twitter facebook buttons toolbar tools print meta byline author date",
    "form login signin signup subscribe subscription newsletter search register contact input email")]
GROUP_OF = {w: i for i, g in enumerate(GROUPS) for w in g}
TAG_SETS = [set(x.split()) for x in (
    "article main", "nav", "footer", "header", "aside", "form fieldset label", "p", "h1 h2", "h3 h4 h5 h6", "ul ol dl",
    "li dt dd", "div", "section", "table tbody thead tr td th", "blockquote pre figure figcaption", "html body #root")]
TAG_OF = {t: i for i, s in enumerate(TAG_SETS) for t in s}
N_TAGS, N_GROUPS = len(TAG_SETS), len(GROUPS)
MARK = "\ue000"  # in training pages: stands before the words of the article


def describe(nodes: list[Node], texts: list[tuple[Node, str]]) -> list[list[float]]:
    """One feature vector per node: tag, attribute words (own, inherited), subtree, depth and sibling statistics."""
    total = 0
    for node, text in texts:
        size = len(text)
        total += size
        node.chars += size
        node.words += text.count(" ") + 1
        node.stops += text.count(".") + text.count(",") + text.count("!") + text.count("?")
    for node in nodes:
        node.paragraphs += node.tag == "p"
        node.heading = node.tag == "h1"
    for node in reversed(nodes):
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.links += node.links
            up.tags += node.tags
            up.words += node.words
            up.stops += node.stops
            up.paragraphs += node.paragraphs
            up.heading |= node.heading
    # where a subtree starts: texts before it
    offset, seen = 0, set()
    place: dict[int, int] = {}
    for node, text in texts:
        up = node
        while up is not None and id(up) not in seen:
            seen.add(id(up))
            place[id(up)] = offset
            up = up.parent
        offset += len(text)

    page = max(total, 1)
    out: list[list[float]] = []
    numbers: dict[int, int] = {}
    kinds_below: dict[int, Counter] = {}
    for i, node in enumerate(nodes):
        numbers[id(node)] = i
        up = node.parent
        tags = [0.0] * N_TAGS
        k = TAG_OF.get(node.tag)
        if k is not None:
            tags[k] = 1.0
        groups = [0.0] * N_GROUPS
        for t in node.tokens:
            g = GROUP_OF.get(t)
            if g is not None:
                groups[g] += 1.0
        if up is not None:
            above = out[numbers[id(up)]]
            # what stands above: own words and kinds of all ancestors, each as a flag
            inherited = [max(a, min(b, 1.0)) for a, b in zip(above[N_TAGS + N_GROUPS:N_TAGS + 2 * N_GROUPS],
                                                             above[N_TAGS:N_TAGS + N_GROUPS])]
            first = N_TAGS + 2 * N_GROUPS
            kinds = [max(a, b) for a, b in zip(above[first:first + 6], above[:6])]
            siblings = up.children
            count = len(siblings)
            if id(up) not in kinds_below:
                kinds_below[id(up)] = Counter(s.tag for s in siblings)
            same = kinds_below[id(up)][node.tag]
            index = (place.get(id(node), 0) - place.get(id(up), 0)) / max(up.chars, 1)
            parent = [up.chars / page, up.link_chars / max(up.chars, 1), math.log1p(up.paragraphs),
                      up.words / max(len(siblings), 1), up.stops / max(up.words, 1)]
        else:
            inherited, kinds, count, same, index, parent = [0.0] * N_GROUPS, [0.0] * 6, 1, 1, 0.0, [0.0] * 5
        chars = max(node.chars, 1)
        out.append([*tags, *groups, *inherited, *kinds, float(node.depth), math.log1p(node.chars), math.log1p(node.own),
                    node.link_chars / chars, math.log1p(node.links), math.log1p(node.tags), node.chars / (node.tags + 1),
                    node.words / (node.runs + len(node.children) + 1), node.stops / max(node.words, 1),
                    math.log1p(node.paragraphs), float(node.heading), node.chars / page,
                    place.get(id(node), 0) / page, float(count), same / count, index,
                    node.chars / max(up.chars, 1) if up is not None else 1.0, *parent])
    return out
