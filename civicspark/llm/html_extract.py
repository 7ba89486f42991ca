"""Main text of web pages by tag-path ratios.

A page becomes a list of blocks (stretches of text that no block element
interrupts), each with its path of block elements from the root.  What markup
itself declares to be no article (menus, headers, footers, sidebars, notices,
adverts, forms, reader comments, scripts, styles, hidden parts) is left out.
For each path the text length and the punctuation of its blocks are added up
and divided by their number.  These ratios are laid over the blocks in page
order, smoothed over neighbours, fused (geometric mean of the two), and a path
is content if its mean reaches the spread (standard deviation) of the page.
Beyond a long paragraph's length and punctuation a ratio counts no further, so
that one very long block does not raise the spread above the paragraphs.

Content paths give the article's root: the innermost element that holds most of
their text, or the article or main element that holds all of it.  Blocks under it
are the article, short ones such as headings and list items too, because only
whole paths were judged, never single blocks.  Content paths outside the root
belong to the article as well, with what else their parents hold, in page order.

Pages are independent: no shuffle, memory follows the longest page.  Defined
cases: a null or empty page, and one without text, give an empty text; broken
markup (unclosed or stray tags, unclosed comments or quotes) is read as a
browser would; rows that repeat give repeated rows.  Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element classes of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
# kept on the stack without ending the block around them: no text of the page
APART = set("svg template annotation annotation-xml".split())
FOREIGN = set("svg math".split())
INLINE_NONE = set("button select label".split())          # the same in a line of text, with a space in their place
HTML_INSIDE = set("foreignobject desc".split())          # parts of an svg that hold HTML
# start tags that end an open svg, as in a browser
BREAKOUT = set("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li
menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var
article aside footer form header main nav section""".split())
BLOCK = set("""html body address article aside blockquote caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol
optgroup option p pre section summary table tbody td tfoot th thead tr ul head button select label""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
# fixed values: what is no article, by element, role or a word of class or id
NO_ARTICLE = set("nav footer aside form head dialog menu fieldset".split())
NO_ROLE = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
NO_WORD = set("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion
nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side aside header footer masthead topbar
comment comments commentlist discussion disqus reply replies notice notices cookie cookies consent alert
popup modal overlay newsletter subscribe signup login share sharing social related recommended widget
toolbar pagination pager hidden""".split())
# a word rejects as the head of its class or id token: the last word before these,
PLAIN_WORD = set("""area slot box wrapper wrap container list section block left right top bottom item items link
links button buttons bar unit panel group thread posts stories inner outer""".split())
NOT_BEHIND = set("has no with without not".split())      # if none of these stands before it
ARTICLE_WORD = set("article post entry content story title".split())     # and, for a header, none of these
COMMENT_WORD = set("comment comments commentlist discussion disqus reply replies".split())
MOST, MOST_COMMENTS = 0.5, 0.9      # of a page's text: an element holding more is not rejected by a word
# elements that a start tag of the same group closes
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "option": {"select"}}
LONG, POINTS = 300, 8       # characters and punctuation marks of a long paragraph
LEAST_SHARE = 0.6           # of the content paths' text that the article's root holds

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


class Doubt(NamedTuple):
    """An element that a word of its class or id rejects, unless it holds the article."""
    number: int
    word: str


class Path:
    """Path of open block elements, linked to its parent, so that an element costs the same at any depth.
    Equal paths of a page are one object; ``nodes`` lists them, parents first."""
    __slots__ = ("name", "parent", "within", "below")

    def __init__(self, name: str, parent: Path | None):
        self.name, self.parent, self.below = name, parent, {}
        # some element of the path is an article or main
        self.within = parent is not None and parent.within or name.split(".")[0] in ("article", "main")

    @property
    def tag(self) -> str:
        return self.name.split(".")[0]

    def child(self, name: str) -> Path:
        if name not in self.below:
            self.below[name] = Path(name, self)
        return self.below[name]

    def nodes(self) -> list[Path]:
        found = [self]
        for node in found:
            found.extend(node.below.values())
        return found


class Block(NamedTuple):
    path: Path
    text: str


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)}


def is_no_article(tag: str, attrs: dict[str, str], path: Path) -> bool:
    if tag in NO_ARTICLE or attrs.get("role", "").lower() in NO_ROLE:
        return True
    if tag == "header":
        return not path.within
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    return False


def rejecting_word(tag: str, attrs: dict[str, str], path: Path) -> str | None:
    """The word of class or id by which an element is no article."""
    if tag in ("html", "body", "article", "main") and "comment" not in attrs.get("class", "").lower():
        return None
    within = path.within
    named = [attrs.get("class", "")]
    if tag not in HEADINGS and not (tag == "section" and within):        # theirs name what they tell of
        named.append(attrs.get("id", ""))
    for token in " ".join(named).lower().split():
        parts = WORD.findall(token)
        while len(parts) > 1 and parts[-1] in PLAIN_WORD:
            parts.pop()
        if not parts or parts[-1] not in NO_WORD or NOT_BEHIND & set(parts[:-1]):
            continue
        if parts[-1] == "header" and (within or ARTICLE_WORD & set(parts)):
            continue
        return parts[-1]
    return None


def blocks(page: str, root: Path) -> list[Block]:
    """Blocks (their paths below ``root``) of the parts that may be article, in page order.  A word rejects no element that holds a main,
    or all articles of the page, or, where there is no article outside it, most of the page's text."""
    articles: list[tuple[str, tuple[Doubt, ...]]] = []
    found = list(doubted_blocks(page, articles, root))
    whole = sum(len(b.text) for b, _ in found)
    share: dict[Doubt, int] = {}
    for b, doubts in found:
        for d in doubts:
            share[d] = share.get(d, 0) + len(b.text)

    def rejected(d: Doubt) -> bool:
        inside = [tag for tag, doubts in articles if d in doubts]
        if "main" in inside or inside and len(inside) == len(articles):
            return False
        return bool(articles) or share[d] <= (MOST_COMMENTS if d.word in COMMENT_WORD else MOST) * whole
    out = {d for d in share if rejected(d)}
    return [b for b, doubts in found if out.isdisjoint(doubts)]


def doubted_blocks(page: str, articles: list[tuple[str, tuple[Doubt, ...]]],
                   root: Path) -> Iterator[tuple[Block, tuple[Doubt, ...]]]:
    """Blocks and the doubted elements around them; ``articles`` gets each article or main and those around it."""
    # element, its path, no article, open elements inside an svg, doubted elements
    stack: list[tuple[str, Path, bool, list[str], tuple[Doubt, ...]]] = []
    open_tags: Counter[str] = Counter()
    number = 0
    text: list[str] = []
    line: list = []                                        # path of the text, doubted elements around it

    def flush() -> Iterator[tuple[Block, tuple[Doubt, ...]]]:
        if text and not (stack and stack[-1][2]):          # inside a control the line around goes on
            whole = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if whole:
                yield Block(line[0], whole), line[1]

    def push(tag: str, name: str, none: bool, doubts: tuple[Doubt, ...]) -> None:
        open_tags[tag] += 1
        stack.append((tag, (stack[-1][1] if stack else root).child(name), none, [], doubts))

    def unwind(upto: int) -> None:
        open_tags.subtract(tag for tag, *_ in stack[upto:])
        del stack[upto:]

    def close(tag: str) -> None:
        if open_tags[tag] > 0:
            unwind(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag))

    def add(part: str) -> None:
        if part and not (stack and stack[-1][2]):
            if not text:
                line[:] = (stack[-1][1], stack[-1][4]) if stack else (root, ())
            text.append(part)

    at = 0
    ahead = TOKEN.search(page)                             # the next whole tag or comment
    while at < len(page):
        if ahead is not None and ahead.start() < at:
            ahead = TOKEN.search(page, at)
        m, lt = ahead, page.find("<", at)
        if lt >= 0 and (m is None or lt < m.start()):      # a lone "<", or a tag with an open quote
            loose = LOOSE.match(page, lt)
            if loose is None:
                add(page[at:lt + 1])
                at = lt + 1
                continue
            m = loose
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if m.lastindex is None:
            continue
        closing, tag = m[1] == "/", m[2].lower()
        foreign = bool(stack) and stack[-1][0] in APART - {"template"}
        if foreign:
            inner = stack[-1][3]
            if closing and tag in inner:                   # an element of the svg itself
                del inner[len(inner) - 1 - inner[::-1].index(tag):]
                continue
            if not closing and tag in BREAKOUT or closing and tag not in APART | HTML_INSIDE | BLOCK:
                while stack and stack[-1][0] in APART - {"template"}:
                    unwind(len(stack) - 1)
            elif not closing and m[3].endswith("/"):
                continue
            elif not closing and tag not in RAW | APART | HTML_INSIDE:
                inner.append(tag)
                continue
        if tag in FOREIGN and m[3].endswith("/"):
            continue
        if tag in APART or foreign and tag in HTML_INSIDE or closing and tag in HTML_INSIDE:
            if not closing:
                push(tag, tag, True, stack[-1][4] if stack else ())
            else:
                close(tag)
            continue
        if tag in RAW:
            if not closing:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                add(" ")
            continue
        if tag in INLINE_NONE:
            if closing:
                close(tag)
                add(" ")
            else:
                add(" ")
                push(tag, tag, True, stack[-1][4] if stack else ())
            continue
        if tag not in BLOCK:
            if tag == "br":
                add(" ")
            continue
        if closing:
            close(tag)
            yield from flush()
            continue
        if tag == "hr":
            yield from flush()
            continue
        for k in range(len(stack) - 1, -1, -1):            # a block start ends an open paragraph
            if stack[k][0] == "p":
                unwind(k)
                break
            if stack[k][0] not in HEADINGS:
                break
        ends = CLOSES.get(tag, ())
        if any(open_tags[t] > 0 for t in ends):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SCOPE.get(tag, ()):
                    break
                if stack[k][0] in ends:
                    unwind(k)
        yield from flush()
        attrs = attributes(m[3]) if m[3].strip(" /") else {}
        path = stack[-1][1] if stack else root
        none = bool(stack and stack[-1][2]) or is_no_article(tag, attrs, path)
        doubts = stack[-1][4] if stack else ()
        word = None if none else rejecting_word(tag, attrs, path)
        if word:
            number += 1
            doubts += (Doubt(number, word),)
        elif tag in ("article", "main") and not none:
            articles.append((tag, doubts))
        kind = ".".join(sorted(attrs.get("class", "").split()))
        push(tag, f"{tag}.{kind}" if kind else tag, none, doubts)
    unwind(0)
    yield from flush()


def smoothed(values: list[float]) -> list[float]:
    """Weighted by 1, 2, 1 over neighbours."""
    n = len(values)
    out = []
    for i, v in enumerate(values):
        near = [(2.0, v)] + [(1.0, values[j]) for j in (i - 1, i + 1) if 0 <= j < n]
        out.append(sum(w * x for w, x in near) / sum(w for w, _ in near))
    return out


def content_paths(found: list[Block]) -> set[Path]:
    total: dict[Path, list[float]] = {}
    for b in found:
        t = total.setdefault(b.path, [0.0, 0.0, 0.0])
        t[0] += 1
        t[1] += len(b.text)
        t[2] += len(PUNCTUATION.findall(b.text))
    length = smoothed([min(LONG, total[b.path][1] / total[b.path][0]) for b in found])
    points = smoothed([min(POINTS, total[b.path][2] / total[b.path][0]) for b in found])
    fused = [math.sqrt(a * (1.0 + p)) for a, p in zip(length, points)]
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((f - mean) ** 2 for f in fused) / len(fused))
    by_path: dict[Path, list[float]] = {}
    for b, f in zip(found, fused):
        by_path.setdefault(b.path, []).append(f)
    return {p for p, f in by_path.items() if sum(f) / len(f) >= spread}


def article_root(found: list[Block], paths: set[Path], nodes: list[Path]) -> Path:
    """The innermost element holding ``LEAST_SHARE`` of the content paths' text; a paragraph
    or the like is no root, its parent is."""
    below = dict.fromkeys(nodes, 0)                       # text of content paths strictly inside
    whole = 0
    for b in found:
        if b.path in paths:
            whole += len(b.text)
            if b.path.parent is not None:
                below[b.path.parent] += len(b.text)
    depth = {nodes[0]: 0}
    for node in nodes[1:]:
        depth[node] = depth[node.parent] + 1
    for node in reversed(nodes[1:]):
        below[node.parent] += below[node]
    share = {p: n for p, n in below.items() if n}
    named = [p for p in share if p.parent is not None and p.tag in ("article", "main")]
    holding_all = [p for p in named if share[p] == whole]
    if holding_all:
        return max(holding_all, key=depth.get)
    good = [p for p in named or share if share[p] >= LEAST_SHARE * whole]
    return max(good or share, key=lambda p: (depth[p] if good else 0, share[p]), default=nodes[0])


def main_text(page: str | None) -> str:
    top = Path("", None)
    found = blocks(page or "", top)
    if not found:
        return ""
    nodes = top.nodes()
    paths = content_paths(found)
    root = article_root(found, paths, nodes)
    parents = {p.parent for p in paths if p.parent is not None}
    # where a parent is the page itself, only content paths and headings beside them are taken
    held = {p for p in parents | {root} if p is not top and p.tag not in ("html", "body")}
    inside: dict[Path, bool] = {}
    for node in nodes:
        inside[node] = node in held or node.parent is not None and inside[node.parent]

    def is_article(path: Path) -> bool:
        return path in paths or inside[path] or path.parent in parents and path.tag in HEADINGS
    return "\n".join(b.text for b in found if is_article(b.path))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.select("page_id", "url").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch["html"]]
            yield pa.record_batch([batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", F.col("html")).mapInArrow(run, f"{kinds}, text string, n_chars long")
