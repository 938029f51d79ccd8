"""Main text of HTML pages by composite text density.

Each node has a density: its characters per tag, lowered by the share of them in links. The node whose children's densities
add up to the most is the core. The content is the outermost article or main around it, whole; without one, the highest node around it
below the body that is made mostly of text outside links, without the menus in it. With it goes what beside the rest of the path to the body is
at least as dense as the least dense node on that path, and headings there; without an article also sections and other prose. Inline markup does not count as tags of its own, so emphasis inside a paragraph leaves its density alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.shipping import pieces, ready

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr td th br img input".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav footer aside button select textarea input iframe object svg "
    "math canvas audio video dialog menu".split()
)
#: Words of a class, id or role that mark menus, adverts, notices and the like. An element with one, or a form, is dropped unless it
#: holds the content: see ``Tree._settle``.
DROPPED_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement banner sponsor sponsored promo cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer comment comments disqus respond replies share sharing social related recommended search toolbar masthead contentinfo "
    "complementary copyright legal disclaimer".split()
)
#: Those that mark reader comments.
COMMENTS = frozenset("comment comments disqus respond replies".split())
#: Words that say nothing by themselves: a class of such words and of dropped ones is a plain name, as ``ad-slot-2`` or ``comment-body``;
#: one with another word, as ``has-sidebar`` or ``social-impact``, may mean something else.
NEUTRAL = frozenset(
    "site page main box block wrap wrapper container inner outer content body area section list item items thread form widget module "
    "slot unit space left right top bottom header links link buttons button bar text message posts post articles stories news "
    "more the of and by is to us email".split()
)
#: Elements whose start closes an open one of the named kind, unless one of the second group stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEPT = frozenset(("html", "body", "main", "article"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text that stay beside the content of a page without article, whatever their density, unless most of their text is
#: in links. Beside an article only headings do.
PROSE = HEADINGS | frozenset("article section p ul ol dl table blockquote pre figure".split())
NAME = re.compile(r"[^a-z0-9]+")
BLANK = re.compile(r"[ \t\n\r\f\v\xa0]+")


class Tree(HTMLParser):
    """The elements of a page in document order, as parallel lists; ``items`` has text and elements in order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.dropped = ["#root"], [-1], [False]
        self.named, self.plain, self.comment = [False], [False], [False]
        self.items: list[list] = [[]]
        self.open = [0]
        self.feed(html)
        self.close()
        self._settle()

    def _add(self, tag: str, attrs) -> int:
        node, parent = len(self.tag), self.open[-1]
        self.tag.append(tag)
        self.parent.append(parent)
        self.dropped.append(self.dropped[parent] or self._is_dropped(tag, attrs))
        named, plain, comment = self._names(tag, attrs)
        self.named.append(named)
        self.plain.append(plain)
        self.comment.append(comment)
        self.items.append([])
        self.items[parent].append(node)
        return node

    def _is_dropped(self, tag: str, attrs) -> bool:
        if tag in KEPT:
            return False
        if tag in DROPPED or tag == "header" and not any(self.tag[k] in ("article", "main") for k in self.open):
            return True
        return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)

    @staticmethod
    def _names(tag: str, attrs) -> tuple[bool, bool, bool]:
        """Whether an element is named as something to drop; whether plainly so; and whether plainly as reader comments."""
        named, plain, comment = tag == "form", False, False
        for name, value in attrs:
            if name not in ("class", "id", "role") or not value:
                continue
            for token in value.lower().split():
                words = [w for w in NAME.split(token) if w]
                if not DROPPED_NAMES.isdisjoint(words):
                    named = True
                    if all(w in DROPPED_NAMES or w in NEUTRAL or w.isdigit() for w in words):
                        plain = True
                        comment = comment or not COMMENTS.isdisjoint(words)
        return named, plain, comment

    def _settle(self) -> None:
        """Drop named elements.

        Plainly named ones stay only with nine tenths of the page's text outside links, or with an article or main in them; reader comments don't
        stay for an article, and an article plainly named goes like any other element. Other named ones stay also with most of
        the text while no article or main stands elsewhere, or with a first-level heading and more text than that.
        """
        n = len(self.tag)
        linked, within, size, heading, articles = [False] * n, [False] * n, [0] * n, [0] * n, [0] * n
        for k in range(1, n):
            linked[k] = linked[self.parent[k]] or self.tag[k] == "a"
            within[k] = within[self.parent[k]] or self.comment[k] and self.tag[k] not in ("html", "body", "main")
        for k in range(n - 1, -1, -1):
            if self.dropped[k]:
                continue
            if not linked[k]:
                size[k] += sum(len(BLANK.sub("", item)) for item in self.items[k] if isinstance(item, str))
            if self.tag[k] == "h1":
                heading[k] = size[k]
            articles[k] += self.tag[k] in ("article", "main") and not within[k] and not self.named[k] and size[k] > 0
            if k:
                p = self.parent[k]
                size[p] += size[k]
                heading[p] += heading[k]
                articles[p] += articles[k]
        inside = [False] * n  # an article or main
        for k in range(1, n):
            p = self.parent[k]
            inside[k] = inside[p] or self.tag[k] in ("article", "main") and not self.named[k]
            whole = self.tag[k] in KEPT and not (self.tag[k] == "article" and self.plain[k])
            if not self.dropped[k] and self.named[k] and not whole:
                most = 2 * size[k] > size[0] and (inside[k] or not articles[0])
                if self.plain[k]:
                    stays = articles[k] and not self.comment[k] or 10 * size[k] > 9 * size[0]
                else:
                    stays = articles[k] or most or 0 < heading[k] < size[k] - heading[k]
                self.dropped[k] = not stays
            self.dropped[k] = self.dropped[k] or self.dropped[p]

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self._close_open({"p"}, {"table", "button", "object"})
        if tag in CLOSES:
            self._close_open(*CLOSES[tag])
        node = self._add(tag, attrs)
        if tag not in VOID:
            self.open.append(node)

    def _close_open(self, kinds, walls):
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in kinds:
                del self.open[k:]
                return
            if tag in walls or tag not in INLINE and tag not in ("td", "th"):
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[k]] == tag:
                del self.open[k:]
                return
            if self.tag[self.open[k]] in ("table", "body") and tag in INLINE:
                return

    def handle_data(self, data):
        self.items[self.open[-1]].append(data)


def _log(base: float, x: float) -> float:
    return math.log(x) / math.log(base) if base > 1 and x > 0 else 0.0


def scores(tree: Tree) -> tuple[list[int], list[int], list[float], list[float], int, int]:
    """Characters and characters in links of every node, its density, the sum of its children's densities; the body, and the node with
    the largest sum in it, of equal ones the first."""
    n = len(tree.tag)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = in_link[tree.parent[k]] or tree.tag[k] == "a"
    for k in range(n - 1, -1, -1):
        if tree.dropped[k]:
            continue
        for item in tree.items[k]:
            if isinstance(item, str):
                size = len(BLANK.sub("", item))
                chars[k] += size
                link_chars[k] += size if in_link[k] else 0
        if k:
            p = tree.parent[k]
            chars[p] += chars[k]
            link_chars[p] += link_chars[k]
            tags[p] += tags[k] + (tree.tag[k] not in INLINE)
            link_tags[p] += link_tags[k] + (tree.tag[k] == "a")
    body = next((k for k in range(n) if tree.tag[k] == "body" and chars[k]), 0)
    share = link_chars[body] / max(1, chars[body])

    def density(k: int) -> float:
        c, lc = chars[k], link_chars[k]
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        weight = _log(base, c / max(1, lc) * max(1, tags[k]) / max(1, link_tags[k])) if base > 1 else math.log(max(c, 2))
        return c / max(1, tags[k]) * max(0.0, weight)

    dense = [0.0 if tree.dropped[k] or tree.tag[k] in INLINE else density(k) for k in range(n)]
    total = [0.0] * n
    for k in range(1, n):
        if not tree.dropped[k]:
            total[tree.parent[k]] += dense[k]
    inside = [k == body for k in range(n)]
    for k in range(1, n):
        inside[k] = inside[k] or inside[tree.parent[k]] and not tree.dropped[k]
    best = max((k for k in range(n) if inside[k]), key=lambda k: (total[k], -k), default=body)
    return chars, link_chars, dense, total, body, best


def main_text(html: str) -> str:
    """The blocks of the main content, each with single blanks, joined by empty lines."""
    tree = Tree(html)
    chars, link_chars, dense, _, body, best = scores(tree)
    path = [best]
    while path[-1] != body:
        path.append(tree.parent[path[-1]])
    floor = min((dense[k] for k in path[:-1]), default=math.inf)  # the body itself holds all the clutter
    mostly_text = lambda k: 2 * link_chars[k] < chars[k]
    whole = [k for k in path if tree.tag[k] in ("article", "main") and k != body]
    top = whole[-1] if whole else next((k for k in reversed(path) if k != body and mostly_text(k)), best)
    on_path, chosen, at = set(path), {top}, path.index(top)
    beside = HEADINGS if whole else PROSE
    for k in path[1 : at + 1] if not whole else ():  # menus beside the content of a page without article
        for c in tree.items[k]:
            if not isinstance(c, str) and c not in on_path and tree.tag[c] not in INLINE and not mostly_text(c) and dense[c] < floor:
                tree.dropped[c] = True
    for k in path[at + 1 :]:
        chosen.update(
            c
            for c in tree.items[k]
            if not isinstance(c, str) and c not in on_path and (dense[c] >= floor > 0 or tree.tag[c] in beside and mostly_text(c))
        )
    return "\n\n".join(_blocks(tree, body, chosen))


def _blocks(tree: Tree, body: int, chosen: set[int]) -> list[str]:
    """Texts of the blocks in the chosen subtrees, in page order."""
    out: list[str] = []
    words: list[str] = []

    def flush():
        block = BLANK.sub(" ", "".join(words)).strip(" ")
        if block:
            out.append(block)
        words.clear()

    stack: list[tuple[int, int, bool]] = [(body, 0, body in chosen)]
    while stack:
        node, at, taken = stack.pop()
        block = tree.tag[node] not in INLINE
        if at == 0 and block:
            flush()
        items = tree.items[node]
        while at < len(items) and isinstance(items[at], str):
            if taken:
                words.append(items[at])
            at += 1
        if at < len(items):
            child = items[at]
            stack.append((node, at + 1, taken))
            if not tree.dropped[child]:
                if tree.tag[child] in ("br", "td", "th", "img", "hr"):
                    words.append(" ")
                stack.append((child, 0, taken or child in chosen))
        elif block:
            flush()
    flush()
    return out


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars`` (its code points).

    Null and empty html, and pages without content, have an empty text. Pages are read as a whole and without recursion, however long
    or deep; rows are independent. Result columns replace input columns of the same name.
    """
    ready(pages)
    made = [T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())]
    own = [f for f in pages.schema.fields if f.name not in (text, n_chars, html)]
    schema = T.StructType([*own, *made])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text=html):
            found = [main_text(h) if h else "" for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in own), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                schema=arrow,
            )

    return pages.select(*(F.col(f"`{f.name}`") for f in own), F.col(html)).mapInArrow(run, schema)
