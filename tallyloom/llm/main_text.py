"""The main text of web pages by scores that paragraphs pass up the tree."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import by_batch, pick

#: Elements that never hold article text.
DROPPED = frozenset("head title script style noscript template svg math canvas iframe object embed audio video map nav footer aside form button select textarea input label fieldset menu dialog datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset("html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote figure figcaption header hgroup address details summary hr center".split())
#: Blocks that are paragraphs themselves: their points go to the parent.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption pre blockquote figcaption summary address".split())
#: An open paragraph ends where one of these begins.
ENDS_P = BLOCKS - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}
_UNLIKELY = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies cta discussion disqus footer gdpr header hidden legal login "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond search share sharing shoutbox sidebar signup "
    "skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
_UNLIKELY_PARTS = ("sidebar", "advert", "cookie", "comment", "newsletter", "breadcrumb", "sponsor", "navbar", "popup")
#: Words after which an unlikely one says what a page wrapper has or lacks ("no-sidebar").
_ABOUT = frozenset("no non not with without has hide".split())
#: Characters; with less text outside, an element that holds most of a page is kept whatever it is called.
SHORT = 250
_LIKELY = frozenset("article body content entry main page post story text blog".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
_KEPT = frozenset(("html", "body", "article", "main"))
_TOKENS = re.compile("[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Node:
    __slots__ = ("tag", "parent", "score", "chars", "link_chars", "first", "last", "is_block", "place", "unlikely")

    def __init__(self, tag: str, parent: Node | None, first: int):
        self.tag, self.parent, self.first, self.last = tag, parent, first, first
        self.score, self.chars, self.link_chars, self.is_block = 0.0, 0, 0, tag in BLOCKS
        self.place, self.unlikely = (0, 0), False

    @property
    def link_density(self) -> float:
        return self.link_chars / self.chars if self.chars else 0.0


class _Page(HTMLParser):
    """Reads a page into a tree whose nodes know which run of text blocks lies in them.

    Elements with unlikely class or id words are dropped, but not those that begin at a place in
    ``spared``; without ``spared`` all of them are read and marked.
    """

    def __init__(self, spared: frozenset[tuple[int, int]] | None = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.root = Node("html", None, 0)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.lost: list[str] = []  # open elements inside one that is dropped, itself first
        self.spared = spared
        self.by_words = False  # the dropped element has unlikely words
        self.lost_chars = self.most_lost = 0
        self.lost_article = False
        self.links = 0
        self.held: list[str] = []
        self.held_links = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.lost:
            if tag not in VOID and tag == self.lost[0]:
                self.lost.append(tag)
            self.lost_article |= self.by_words and tag in ("article", "main")
            return
        if tag in VOID:
            if tag in ("br", "hr"):
                self.held.append(" ")
            return
        if tag in ENDS_P:
            self.end("p", stop=("td", "th", "li", "blockquote", "div", "article", "section", "main"))
        if tag in ("li", "dt", "dd", "tr", "td", "th"):
            self.end(tag, stop=("ul", "ol", "dl", "table"))
        if tag in BLOCKS:
            self.flush()
        dropped, unlikely = self.is_dropped(tag, attrs), unlikely_words(tag, attrs)
        if dropped or unlikely and tag not in _KEPT and self.spared is not None and self.getpos() not in self.spared:
            self.flush()
            self.lost.append(tag)
            self.by_words, self.lost_chars = not dropped, 0
            return
        if tag == "a":
            self.links += 1
        node = Node(tag, self.stack[-1], len(self.blocks))
        node.place, node.unlikely = self.getpos(), unlikely
        self.bonus(node, attrs)
        self.stack.append(node)
        self.nodes.append(node)

    def is_dropped(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED:
            return True
        if tag in _KEPT:
            return False
        if tag == "header":
            return not any(n.tag in ("article", "main") for n in self.stack)
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in _ROLES or name == "style" and _HIDDEN.search(value):
                return True
        return False

    def bonus(self, node: Node, attrs: list[tuple[str, str | None]]) -> None:
        node.score = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "blockquote": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "table": -3.0, "li": -3.0}.get(node.tag, 0.0)
        if any(name in ("class", "id") and _LIKELY & {*_TOKENS.findall((value or "").lower())} for name, value in attrs):
            node.score += 25.0

    def handle_endtag(self, tag: str) -> None:
        if self.lost:
            if tag == self.lost[0]:
                self.lost.pop()
            elif tag in ("body", "html") or tag in ("article", "main") and self.lost[0] not in ("article", "main") and any(n.tag == tag for n in self.stack):
                self.lost.clear()  # the dropped element was never closed
                self.end(tag)
            return
        if tag == "br":
            self.held.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        self.end(tag, stop=() if tag in BLOCKS else tuple(PARAGRAPHS))

    def end(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        """Ends the innermost open ``tag``, with all that is open in it, unless a ``stop`` lies between."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                break
            if self.stack[i].tag in stop:
                return
        else:
            return
        if any(node.is_block for node in self.stack[i:]):
            self.flush()
        for node in self.stack[i:]:
            node.last = len(self.blocks)
            self.links -= node.tag == "a"
        del self.stack[i:]

    def handle_data(self, data: str) -> None:
        if self.lost:
            if self.by_words:
                self.lost_chars += len(data.strip())
                self.most_lost = max(self.most_lost, self.lost_chars)
        else:
            self.held.append(data)
            if self.links:
                self.held_links += len(data)

    def flush(self) -> None:
        """Ends a block of text and passes its points up the tree."""
        text = " ".join("".join(self.held).split())
        links, self.held, self.held_links = min(self.held_links, len(text)), [], 0
        if not text:
            return
        self.blocks.append(text)
        for node in self.stack:
            node.chars += len(text)
            node.link_chars += links
        points = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        points *= 1 - links / len(text)
        level, owner = 1, next((n for n in reversed(self.stack) if n.is_block), self.root)
        node = owner.parent if owner.tag in PARAGRAPHS and owner.parent else owner
        while node is not None:
            if node.is_block:
                node.score += points / (1 if level == 1 else 2 if level == 2 else level * 3)
                level += 1
            node = node.parent

    def finish(self) -> None:
        self.close()
        self.flush()
        for node in self.stack:
            node.last = len(self.blocks)


def unlikely_words(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether class or id have words that article text seldom has."""
    if tag in ("html", "body", "header"):
        return False
    for name, value in attrs:
        tokens = _TOKENS.findall((value or "").lower())
        if name not in ("class", "id") or "article" in tokens:
            continue
        for before, token in zip(["", *tokens], tokens, strict=False):
            if before not in _ABOUT and (token in _UNLIKELY or any(part in token for part in _UNLIKELY_PARTS)):
                return True
    return False


def _read(html: str, spared: frozenset[tuple[int, int]] | None = frozenset()) -> _Page:
    page = _Page(spared)
    page.feed(html)
    page.finish()
    return page


def _wrappers(page: _Page) -> frozenset[tuple[int, int]]:
    """Places of the elements that are the page's frame, not clutter, though their words are unlikely.

    From outside in: while no article or main is left, the element that holds a main, or the longest
    article if less text than that is left outside; then what holds most of the page's text, mostly without
    links, if less than ``SHORT`` is left outside or, while no article or main is left, if it holds an h1.
    """
    over: dict[int, Node | None] = {}  # the innermost unlikely element that a node lies in or is
    inner: dict[int, list[Node]] = {id(None): []}
    longest: dict[int, int] = {}
    with_h1: set[int] = set()
    direct: set[int] = set()  # where an article or main lies, with no other unlikely element between
    outside: dict[int, Node | None] = {}
    for node in page.nodes:
        above = over[id(node.parent)] if node.parent else None
        unlikely = node.unlikely and node.tag not in _KEPT
        over[id(node)] = node if unlikely else above
        if unlikely:
            outside[id(node)] = above
            inner[id(above)].append(node)
            inner[id(node)] = []
        elif node.chars and not node.unlikely and node.tag in ("article", "main", "h1"):
            up, chars = above, node.chars + page.root.chars * (node.tag == "main")
            if node.tag != "h1":
                direct.add(id(above))
            while up is not None and (id(up) not in with_h1 if node.tag == "h1" else longest.get(id(up), 0) < chars):
                if node.tag == "h1":
                    with_h1.add(id(up))
                else:
                    longest[id(up)] = chars
                up = outside[id(up)]
    top, spared = inner[id(None)], set()
    has_article, left = id(None) in direct, page.root.chars - sum(n.chars for n in top)
    while top:
        best = max(top, key=lambda n: longest.get(id(n), 0))
        if has_article or longest.get(id(best), 0) <= left:
            best = max(top, key=lambda n: n.chars)
            if 2 * best.chars <= page.root.chars or best.link_density >= 0.25 or not (left < SHORT or not has_article and id(best) in with_h1):
                break
        spared.add(best.place)
        has_article |= id(best) in direct
        left += best.chars - sum(n.chars for n in inner[id(best)])
        top = [n for n in top if n is not best] + inner[id(best)]
    return frozenset(spared)


def main_text(html: str) -> str:
    """The text of the best container and of the siblings that read like it; empty if there is none.

    Elements go by their class and id words only if they are clutter by what they hold: a page that loses an
    article or most of its text to them is read again without them, and its wrappers are spared.
    """
    page = _read(html)
    if page.lost_article or page.most_lost > page.root.chars:
        spared = _wrappers(_read(html, None))
        page = _read(html, spared) if spared else page
    containers = [n for n in page.nodes if n.is_block and n.tag not in PARAGRAPHS and n.last > n.first]
    if not containers:
        return " ".join(page.blocks)
    rank = {id(n): n.score * (1 - n.link_density) for n in page.nodes}
    best = max(containers, key=lambda n: rank[id(n)])
    for node in containers:  # an article around the best container is the whole of it
        up = best.parent
        while up is not None and up is not node:
            up = up.parent
        if up is node and node.tag in ("article", "main"):
            best = node
            break
    kept = [(best.first, best.last)]
    if best.parent is not None and best.tag not in ("article", "main"):
        least = max(10.0, 0.2 * rank[id(best)])
        for node in page.nodes:
            if node.parent is best.parent and node is not best and node.is_block and node.last > node.first:
                density, text = node.link_density, page.blocks[node.last - 1]
                prose = density < 0.25 and (node.chars > 80 or density == 0 and text[-1:] in ".!?。") if node.tag in PARAGRAPHS else False
                if prose or rank[id(node)] >= least or node.tag in ("h1", "h2") and density < 0.25 and node.last <= best.first:
                    kept.append((node.first, node.last))
    return " ".join(" ".join(page.blocks[a:b]) for a, b in sorted(kept))


def extract_pages(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The main text of every row's whole html, and its length in code points.

    Null and empty html give an empty text. Rows are independent: one row in, one out, repeated ones
    too, nothing is shuffled, and a task holds one batch and the tree of one page. Broken markup
    never raises: unclosed and stray tags are read as a browser would, an unknown declaration is a comment.
    """
    rows = pick(pages, key, url, html)
    kinds = dict(rows.dtypes)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h.as_py() or "") for h in batch.column(2)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"]
        )

    return rows.mapInArrow(by_batch(make), f"{key} {kinds[key]}, {url} {kinds[url]}, text string, n_chars long")
