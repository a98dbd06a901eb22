"""A page as a small tree of block nodes with the features that the extraction model reads."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

# Element names by their role in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe svg math object select option datalist".split())
BLOCKS = set(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption header footer nav aside form fieldset address details summary dialog menu center "
    "hgroup search ins legend".split()
)
TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th figcaption caption #text".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CHROME = set("nav header footer aside form menu dialog fieldset address search legend".split())
MAIN = set("article main".split())
# A start tag of a key's set ends an open element of the key.
ENDED_BY = {
    "p": BLOCKS,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "head": {"body"},
}
# The other way round: for a start tag, the open elements it ends.
ENDS = {name: [k for k, enders in ENDED_BY.items() if name in enders] for name in set().union(*ENDED_BY.values())}
# Words of class, id and role attributes that speak against or for main text.
AGAINST = set(
    "nav navbar navigation menu header masthead banner footer foot sidebar side aside widget ad ads advert advertisement "
    "adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter "
    "subscribe signup login form search share social follow related recommended more popular trending breadcrumb "
    "breadcrumbs crumbs pagination pager comment comments disqus reply replies discussion respond tags tag meta byline "
    "copyright legal skip toolbar topbar tools contentinfo complementary dialog rail teaser".split()
)
FOR = set("article content main post entry story body text prose page maintext articlebody postcontent".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"\b(class|id|role|data-keep)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_STOPS = re.compile(r"[.,;:!?]")

FEATURES = (
    "depth", "log_chars", "link_share", "chars_per_node", "children", "stop_share", "words_per_text", "page_share",
    "parent_share", "place", "same_tag_siblings", "sibling_link_share", "text_tag", "heading", "chrome_tag", "main_tag",
    "against", "for", "above_against", "above_main", "chrome_above", "own_words", "ends_sentence", "list_like", "hidden",
    "below_against", "below_main",
)


class Node:
    __slots__ = (
        "tag", "parent", "children", "depth", "text", "chars", "links", "stops", "texts", "nodes", "against", "favour",
        "hidden", "keep", "words", "index", "below_against", "below_main",
    )

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.text, self.links, self.keep, self.hidden = None, 0, None, False
        self.against = self.favour = 0


def _describe(node: Node, attributes: str) -> None:
    for name, a, b, c in _ATTR.findall(attributes):
        value = a or b or c
        if name.lower() == "data-keep":
            node.keep = value == "1"
            continue
        tokens = set(_WORDS.findall(_CAMEL.sub(" ", value).lower())) | set(_WORDS.findall(value.lower()))
        node.against += len(tokens & AGAINST)
        node.favour += len(tokens & FOR)
    node.hidden = bool(_HIDDEN.search(attributes))


def parse(page: str) -> list[Node]:
    """The block nodes in page order, each stretch of text as a ``#text`` leaf; the first node is the root.

    Nesting is mended as browsers do for the common cases: implied ends, stray
    end tags, missing ends. Text that is never shown is left out.
    """
    root = Node("#root", None)
    order, stack = [root], [(root, "#root")]
    # How many elements of each name are open, so that an end tag without its element costs nothing.
    held: Counter[str] = Counter()
    words: list[str] = []
    link_chars, in_link, at, owner = 0, 0, 0, root

    def flush() -> None:
        nonlocal words, link_chars
        text = _SPACE.sub(" ", html.unescape("".join(words))).strip() if words else ""
        if text:
            leaf = Node("#text", owner)
            leaf.text, leaf.links = text, min(link_chars, len(text))
            owner.children.append(leaf)
            order.append(leaf)
        words, link_chars = [], 0

    size = len(page)
    while at < size:
        found = _PIECE.search(page, at)
        if found is None:
            words.append(page[at:])
            break
        if found.start() > at:
            piece = page[at : found.start()]
            words.append(piece)
            if in_link:
                link_chars += len(piece.strip())
        at = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            if name == "a":
                in_link = 0
            if held[name]:
                if name in BLOCKS:
                    flush()
                while True:
                    _, popped = stack.pop()
                    held[popped] -= 1
                    if popped == "a":
                        in_link = 0
                    if popped == name:
                        break
                owner = stack[-1][0]
            elif name in BLOCKS:
                flush()
            continue
        if name in RAW:
            if not attributes.endswith("/") or name in ("script", "style"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else size if name in ("script", "style", "title", "textarea") else at
            continue
        if name in VOID:
            if name in ("br", "hr", "img", "input"):
                words.append(" ")
            if name == "hr":
                flush()
            continue
        if name == "a":
            in_link = 1
            stack.append((owner, "a"))
            held["a"] += 1
            continue
        if name not in BLOCKS:
            if not attributes.endswith("/"):
                stack.append((owner, name))
                held[name] += 1
            continue
        flush()
        ends = any(held[n] for n in ENDS.get(name, ()))
        for k in range(len(stack) - 1, 0, -1) if ends else ():
            if name in ENDED_BY.get(stack[k][1], ()):
                held.subtract(n for _, n in stack[k:])
                del stack[k:]
                in_link = 0
                break
            if stack[k][1] in BLOCKS:
                break
        owner = stack[-1][0]
        node = Node(name, owner)
        if attributes:
            _describe(node, attributes)
        owner.children.append(node)
        order.append(node)
        stack.append((node, name))
        held[name] += 1
        owner = node
    flush()
    return order


def features(order: list[Node]) -> list[list[float]]:
    """A row for each node of ``parse``; sums over subtrees go up, what stands above goes down."""
    for k, n in enumerate(order):
        n.index = k
        if n.text is not None:
            n.chars, n.stops, n.texts = len(n.text), len(_STOPS.findall(n.text)), 1
            n.words = n.text.count(" ") + 1
        else:
            n.chars = n.stops = n.texts = n.words = n.links = 0
        n.nodes, n.below_against, n.below_main = 1, 0, 0
    for n in reversed(order[1:]):
        p = n.parent
        p.chars += n.chars
        p.links += n.links
        p.stops += n.stops
        p.texts += n.texts
        p.words += n.words
        p.nodes += n.nodes
        p.below_against += n.below_against + (n.chars if n.against or n.tag in CHROME else 0)
        p.below_main += n.below_main + (n.tag in MAIN or n.favour > 0)
    total = max(order[0].chars, 1)
    above: list[tuple[int, int, int]] = [(0, 0, 0)] * len(order)
    rows, seen = [], 0
    tags_of: dict[int, dict[str, int]] = {}
    for n in order:
        p = n.parent
        if p is not None:
            a = above[p.index]
            above[n.index] = (
                a[0] + (p.against > 0), a[1] + (p.tag in MAIN or p.favour > 0), a[2] + (p.tag in CHROME)
            )
            if p.index not in tags_of:
                counts: dict[str, int] = {}
                for c in p.children:
                    counts[c.tag] = counts.get(c.tag, 0) + 1
                tags_of[p.index] = counts
            same = tags_of[p.index][n.tag]
            rest = p.chars - n.chars
            sibling_links = (p.links - n.links) / rest if rest else 0.0
        else:
            same, sibling_links = 1, 0.0
        chars = max(n.chars, 1)
        up = above[n.index]
        last = n.text if n.text is not None else next((c.text for c in reversed(n.children) if c.text), "")
        rows.append(
            [
                n.depth, math.log1p(n.chars), n.links / chars, n.chars / n.nodes, len(n.children), n.stops / chars,
                n.words / max(n.texts, 1), n.chars / total, n.chars / max(p.chars, 1) if p else 1.0, seen / total, same,
                sibling_links, n.tag in TEXT_TAGS, n.tag in HEADINGS, n.tag in CHROME, n.tag in MAIN, n.against, n.favour,
                up[0], up[1], up[2], n.words, bool(last) and last[-1] in ".!?\"'”»…", n.tag in ("ul", "ol", "li", "dl"),
                n.hidden, n.below_against / chars, n.below_main,
            ]
        )
        if n.text is not None:
            seen += n.chars
    return rows


def decode(order: list[Node], scores: list[float]) -> str:
    """The main text under the best consistent choice of nodes.

    A node's score is its log odds of being main text. A node can only be
    chosen if all above it are, so a subtree is worth its root's score and the
    positive worth of its children; what is worth nothing goes as a whole.
    """
    worth = list(scores)
    for n in reversed(order[1:]):
        if worth[n.index] > 0:
            worth[n.parent.index] += worth[n.index]
    chosen = [False] * len(order)
    chosen[0] = True
    parts = []
    for n in order[1:]:
        if chosen[n.parent.index] and worth[n.index] > 0:
            chosen[n.index] = True
            if n.text is not None:
                parts.append(n.text)
    return "\n\n".join(parts)
