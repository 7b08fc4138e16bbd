"""Main text of web pages by composite text density.

A page becomes a tree of its tags, without subtrees that are never article text (scripts, menus, forms, adverts,
reader comments and the like, known by tag, role or class words). Class words only mark a subtree: it stays if it
holds what the page calls its main part or article, or most of the page's text outside links. Every node gets its
link-adjusted characters per tag; a node's sum of its children's densities says how much text hangs directly below
it. The subtree with the largest sum is the core of the article. The smallest article, main or content element around
the core is taken whole. Beyond it the smallest density on the path to the body, with the subtrees cut above counted
in, is the threshold: neighbours of the path that reach it belong to the article too, and so do a first heading and
sections beside a section.

Character references are decoded; white space inside a block is one space; blocks are joined by a line feed. A null
or empty page, and one without text, give an empty text; pages are read whole and broken markup is no error. Repeated rows
give equal results, columns beside the three read are left out, an empty table gives no rows. Time grows with the page's length.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by what they mean for the text.
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
RAW = set("script style textarea title xmp noembed noframes".split())
NEVER = set("head script style noscript template iframe object svg canvas nav footer aside form button select textarea dialog audio video map".split())
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Roles, and words of class and id, of what is not the article.
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar".split())
ASIDES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice notices alert popup modal overlay newsletter "
    "subscribe subscription comment comments disqus reply replies respond related recommended share sharing social widget "
    "pagination pager login signup masthead".split()
)

REPLIES = {"comment", "comments", "disqus", "reply", "replies", "respond"}
# Words that turn a name into a property of the layout (``has-sidebar``, ``comment-enabled``).
BEFORE, AFTER = {"has", "no", "not", "with", "without"}, {"enabled", "disabled", "open", "closed", "on", "off"}
# Class and id names of the element that holds the article.
CONTENT = set(
    "content article post entry story main article-body article-content post-body post-content entry-content story-body "
    "main-content content-body articlebody".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/)?(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?:[!?/][^>]*+>?|[A-Za-z/][^>]*+>)|[^<]++|<",
    re.S,
)
#: The same behind the last ``>``, where no tag can end.
TAIL = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*+>?|[^<]++|<", re.S)
ATTRIBUTE = re.compile(r"((?<![^\s=\"'/>])[^\s=\"'/>]++)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b")
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def _aside(tag: str, rest: str, inside: bool) -> tuple[bool, set[str], bool]:
    """Whether a subtree is never article text, its words that say so, whether it is the content's element.

    ``inside``: an article or main element is open.
    """
    content = tag in ("article", "main")
    if tag in NEVER or tag == "header" and not inside:
        return True, set(), False
    words: set[str] = set()
    if not rest.strip(" /"):
        return False, words, content
    for name, value, hidden in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if hidden or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True, words, False
        if tag in ("body", "html"):
            continue
        if name == "role" and value in ROLES and tag not in ("article", "main"):
            return True, words, False
        content |= name == "role" and value == "main"
        if name in ("class", "id"):
            for one in value.split():
                parts = [x for x in re.split(r"[^a-z0-9]+", one) if x]
                if parts and parts[0] not in BEFORE and parts[-1] not in AFTER and tag not in ("article", "main"):
                    words |= ASIDES.intersection(parts)
                content |= one in CONTENT
    return False, words, content


class Tree:
    """Nodes in page order: parent, tag, and the text pieces and children below each, in order."""

    def __init__(self, page: str):
        self.parent, self.tag, self.below = [-1], ["#page"], [[]]
        self.cut: set[int] = set()
        self.marked: dict[int, set[str]] = {}
        self.content: set[int] = set()
        self._build(page)
        self.direct = [sum(len(SPACES.sub("", html.unescape(x) if "&" in x else x)) for x in below if isinstance(x, str)) for below in self.below]
        self._cut_marked()

    def _open(self, stack: list[int], tag: str) -> None:
        self.parent.append(stack[-1])
        self.tag.append(tag)
        self.below.append([])
        self.below[stack[-1]].append(len(self.tag) - 1)

    def _build(self, page: str) -> None:
        stack, at, last = [0], 0, page.rfind(">")
        places: dict[str, list[int]] = {}  # where in the stack the open elements of a tag are
        while at < len(page):
            m = (TOKEN if at < last else TAIL).match(page, at)
            at = m.end()
            tag = m["tag"] if m.re is TOKEN else None
            if tag is None:
                text = m[0]
                if text[0] != "<" or text == "<":
                    self.below[stack[-1]].append(text)
                continue
            tag = tag.lower()
            if m["close"]:
                self._close(stack, places, {tag}, set())
                continue
            if tag in CLOSES_P:
                self._close(stack, places, {"p"}, {"table", "td", "th", "button", "li", "div", "article", "section", "body"})
            if tag in SAME_CLOSES:
                self._close(stack, places, SAME_CLOSES[tag], HOLDS[tag])
            inside = bool(places.get("article") or places.get("main"))
            self._open(stack, tag)
            node = len(self.tag) - 1
            never, words, content = _aside(tag, m["rest"], inside)
            if never:
                self.cut.add(node)
            elif words:
                self.marked[node] = words
            if content:
                self.content.add(node)
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at, last + 1)
                if tag in ("xmp", "noembed", "noframes"):
                    self.below[node].append(page[at : end.start() if end else len(page)])
                at = end.end() if end else len(page)
            elif tag not in VOID and not m["rest"].endswith("/"):
                places.setdefault(tag, []).append(len(stack))
                stack.append(node)

    def _close(self, stack: list[int], places: dict[str, list[int]], tags: set[str], stop: set[str]) -> None:
        """Closes the innermost open element of the tags, and all inside it, unless one of ``stop`` lies further in."""
        innermost = lambda names: max((places[t][-1] for t in names if places.get(t)), default=0)
        depth = innermost(tags)
        if depth and depth >= innermost(stop):
            for k in stack[depth:]:
                places[self.tag[k]].pop()
            del stack[depth:]

    def blocks(self, roots: list[int]) -> list[str]:
        """Texts of the blocks below the roots, in page order."""
        out, line = [], []

        def end() -> None:
            text = SPACES.sub(" ", "".join(line)).strip(" ")
            if text:
                out.append(text)
            line.clear()

        for root in roots:
            todo: list = [root]
            while todo:
                x = todo.pop()
                if x is None:
                    end()
                elif isinstance(x, str):
                    line.append(html.unescape(x) if "&" in x else x)  # a reference ends with its piece of text
                elif x not in self.cut:
                    block = self.tag[x] in BLOCKS or x == root
                    if block:
                        end()
                        todo.append(None)
                    todo += reversed(self.below[x])
            end()
        return out

    def _cut_marked(self) -> None:
        """Cuts the marked nodes that hold neither the page's main part nor most of its text outside links."""
        if not self.marked:
            return
        n = len(self.tag)
        lost, linked = [False] * n, [False] * n
        for k in range(1, n):
            lost[k] = lost[self.parent[k]] or k in self.cut
            linked[k] = linked[self.parent[k]] or self.tag[k] == "a"
        named = next((found for tag in ("main", "article") if (found := [k for k in range(n) if self.tag[k] == tag and not lost[k]])), [])
        chars = [0 if lost[k] or linked[k] else self.direct[k] for k in range(n)]
        held = [0] * n
        for k in named:
            held[k] = 1
        for k in range(n - 1, 0, -1):
            chars[self.parent[k]] += chars[k]
            held[self.parent[k]] += held[k]
        for k, words in self.marked.items():
            most = not named and not words & REPLIES and 2 * chars[k] > chars[0]
            if not (named and held[k] == len(named) or most):
                self.cut.add(k)

    def densities(self, uncut: bool = False) -> list[float]:
        """Composite text density of every node; nodes of cut subtrees have none unless ``uncut``."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for k in range(n - 1, -1, -1):  # children come after their parents
            if k in self.cut and not uncut:
                continue
            chars[k] += self.direct[k]
            if self.tag[k] == "a":
                link_chars[k] = chars[k]
                link_tags[k] += 1
            up = self.parent[k]
            if up >= 0:
                chars[up] += chars[k]
                tags[up] += tags[k] + 1
                link_chars[up] += link_chars[k]
                link_tags[up] += link_tags[k]
        whole, share = max(1, chars[0]), link_chars[0] / max(1, chars[0])
        made = []
        for k in range(n):
            c, t, lc, lt = chars[k], max(1, tags[k]), link_chars[k], max(1, link_tags[k])
            if not c or whole <= 0:
                made.append(0.0)
                continue
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            made.append(c / t * max(0.0, math.log(c / max(1, lc) * t / lt)) / math.log(base) if base > 1 + 1e-9 and math.log(base) > 1e-9 else c / t * max(0.0, math.log(c / max(1, lc) * t / lt)))
        return made

    def article(self) -> list[int]:
        """Roots of the article's subtrees, in page order."""
        density = self.densities()
        total = [0.0] * len(density)
        lost = set(self.cut)
        for k in range(1, len(density)):
            if self.parent[k] in lost:
                lost.add(k)
            if k not in lost and self.tag[k] in BLOCKS:  # marked-up words are part of their block
                total[self.parent[k]] += density[k]
        best = max(range(len(total)), key=lambda k: (total[k], -k))
        if not total[best]:
            return [0]
        path = [best]
        while path[-1] > 0 and self.tag[path[-1]] != "body":
            path.append(self.parent[path[-1]])
        first = next((d for d, k in enumerate(path) if k in self.content), 0)
        path, roots = path[first:], [path[first]]
        uncut = self.densities(uncut=True)
        threshold = min((uncut[k] for k in path if uncut[k] > 0), default=0.0)
        for above, below in zip(path[1:], path, strict=False):
            for at, k in enumerate(self.below[above]):
                if isinstance(k, str):
                    size = len(SPACES.sub("", html.unescape(k)))
                    if size and size * math.log(size) >= threshold > 0:
                        roots.append(self._wrap(above, at))
                elif k != below and k not in lost:
                    beside = self.tag[k] == "h1" and k < below or self.tag[k] == self.tag[below] == "section" and density[k] > 0
                    if beside or density[k] >= threshold > 0:
                        roots.append(k)
        return self._in_order(roots)

    def _wrap(self, above: int, at: int) -> int:
        """A node of its own for a text piece, so that it can be a root."""
        self.parent.append(above)
        self.tag.append("#text")
        self.below.append([self.below[above][at]])
        self.below[above][at] = len(self.tag) - 1
        return len(self.tag) - 1

    def _in_order(self, roots: list[int]) -> list[int]:
        """The roots in page order: none lies inside another."""
        left, out, todo = set(roots), [], [0]
        while todo and left:
            k = todo.pop()
            if k in left:
                left.discard(k)
                out.append(k)
                continue
            todo += reversed([x for x in self.below[k] if isinstance(x, int)])
        return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = Tree(page)
    return "\n".join(tree.blocks(tree.article()))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
