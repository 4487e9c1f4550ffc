"""Main text of web pages by tree scoring.

The page is read into a light tree: tags by one pattern, unclosed paragraphs, list
items and cells closed by what follows them, a head by the first tag or text of a body, stray end tags and a tag that the page's end cuts off ignored. Elements whose tag, role or
class says menu, header, footer, sidebar, notice, advert, form or reader comment are
taken out with all they hold; a class or id says so if all its words do, words of layout aside. Every paragraph then passes points to its ancestors: one, one
for each comma and one for each hundred characters up to three, in full to the
parent, half to the next and a third of the level beyond; an ancestor's sum is
discounted by its share of link text. The container with most points, and those
of its siblings that score well or read as prose, are the page's text; an article
or main element around the container is taken instead of it. If no paragraph is
long enough to score, the length limit is dropped.

Null or empty pages, and pages with no text left, have the empty string. Repeated
pages give repeated rows. Columns besides ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rungwise.llm.common import read_table, slices

SHORTEST = 25  # characters of a paragraph that scores
RAW = "script|style|iframe|textarea|title"
EMBEDDED = set("noscript template svg math object canvas select".split())  # out with what they hold, if they end at all
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])(?:"[^"]*"|'[^']*'|[^>"'])*/>"""
    rf"|<(?P<raw>{RAW})\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)|<[!?][^>]*>"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"'])*)>"""
    r"|</?[a-zA-Z][^<>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
ATTR = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([\w:-]+)""")
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
VOID = set("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
PARAGRAPH = set("p pre td blockquote li dd figcaption h1 h2 h3 h4 h5 h6".split())
OUT_TAGS = set("nav header footer aside form button menu dialog input label fieldset".split())
# Words of layout: beside a word of the list below they leave a name's meaning as it is.
PLAIN_WORDS = set(
    "area bar block body bottom box btn button buttons col column container content head holder icon icons inner item items "
    "left links list main module outer page panel post posts right row section site slot text thread top unit wrap wrapper".split()
)
OUT_ROLES = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
OUT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond cookie "
    "cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup login share sharing social "
    "related recommended widget pager pagination toolbar skip".split()
)
CLOSES = {  # a start tag of the first closes an open one of the second, looking no further than the third
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr"}, {"table"}),
}
HEAD = set("base basefont bgsound link meta".split())  # besides elements read as one; all others end the head
SCOPES = set("article main section div body table ul ol td form nav aside header footer blockquote".split())


def says_out(name: str) -> bool:
    """Whether a class name or id says boilerplate: ``related-posts`` does, ``related-work`` and ``share-price`` do not."""
    words = re.sub(r"[-_0-9]+", " ", re.sub(r"([a-z])([A-Z])", r"\1 \2", name)).lower().split()
    told = [word for word in words if word not in PLAIN_WORDS]
    return bool(told) and OUT_WORDS.issuperset(told) or "".join(words) in OUT_WORDS


def is_out(name: str, attrs: str) -> bool:
    """Whether an element is boilerplate by its tag, role, class or id."""
    if name in OUT_TAGS or name in EMBEDDED or name == "head":
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, a, b, c, bare in ATTR.findall(attrs):
        key, value = (key or bare).lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value.lower() in OUT_ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key in ("class", "id") and any(map(says_out, value.split())):
            return True
    return False


class Tree:
    """Nodes by number in page order, and the page's texts with the node that holds them."""

    def __init__(self, page: str):
        self.names, self.parents, self.out, self.texts = ["root"], [-1], [False], []
        stack, at, lower = [0], 0, page.lower()
        last_end = {name: lower.rfind("</" + name) for name in EMBEDDED}
        for tag in TAG.finditer(page):
            if tag.start() > at:
                self._text(stack, page[at : tag.start()])
            at, name = tag.end(), tag["name"]
            if name is None:
                continue
            name = name.lower()
            if tag["end"]:
                self._close(stack, name)
            elif name not in EMBEDDED or last_end[name] >= at:  # one that never ends holds nothing
                self._open(stack, name, tag["attrs"])
        if at < len(page):
            self._text(stack, page[at:])

    def _text(self, stack: list[int], text: str) -> None:
        if self.names[stack[-1]] == "head" and not text.isspace():
            stack.pop()
        self.texts.append((stack[-1], text))

    def _open(self, stack: list[int], name: str, attrs: str) -> None:
        if self.names[stack[-1]] == "head" and name not in HEAD:
            stack.pop()
        if name in BLOCK:
            self._cut(stack, {"p"}, SCOPES)
        if name in CLOSES:
            self._cut(stack, *CLOSES[name])
        self.names.append(name)
        self.parents.append(stack[-1])
        self.out.append(self.out[stack[-1]] or is_out(name, attrs))
        if name == "br":
            self.texts.append((stack[-1], " "))
        elif name not in VOID and not attrs.endswith("/"):
            stack.append(len(self.names) - 1)

    def _cut(self, stack: list[int], names: set[str], until: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            name = self.names[stack[i]]
            if name in names:
                del stack[i:]
                return
            if name in until:
                return

    def _close(self, stack: list[int], name: str) -> None:
        until = set() if name in SCOPES or name in BLOCK - {"p"} else SCOPES
        self._cut(stack, {name}, until)


def main_text(page: str, shortest: int = SHORTEST) -> str:
    """The text of the best container and its siblings, blocks joined by one space."""
    tree = Tree(page)
    names, parents, count = tree.names, tree.parents, len(tree.names)
    length, links, commas = [0] * count, [0] * count, [0] * count
    block = [0] * count  # the nearest block around each node, itself included
    linked = [False] * count
    for node in range(1, count):
        block[node] = node if names[node] in BLOCK else block[parents[node]]
        linked[node] = names[node] == "a" or linked[parents[node]]
    texts = []
    for node, text in tree.texts:
        if tree.out[node]:
            continue
        text = html.unescape(text) if "&" in text else text
        size = len(" ".join(text.split()))
        texts.append((node, text))
        home = block[node]
        length[home] += size
        commas[home] += text.count(",")
        if linked[node]:
            links[home] += size
    points = scores_of(names, parents, tree.out, length, commas, shortest)
    if not any(points):
        points = scores_of(names, parents, tree.out, length, commas, 1)
    for node in range(count - 1, 0, -1):  # own sums to sums of the subtree
        length[parents[node]] += length[node]
        links[parents[node]] += links[node]
    for node in range(count):
        points[node] *= 1 - links[node] / max(length[node], 1)
    best = max(range(count), key=lambda node: (points[node], -node))
    if points[best] <= 0:
        return ""
    keep = container(names, parents, best)
    kept = {keep} | siblings(names, parents, tree.out, points, length, links, keep)
    inside = [False] * count
    for node in range(count):
        inside[node] = node in kept or (node > 0 and inside[parents[node]])
    parts, last = [], None
    for node, text in texts:
        if inside[node]:
            if block[node] != last:
                parts.append(" ")
            parts.append(text)
            last = block[node]
    return " ".join("".join(parts).split())


def scores_of(names, parents, out, length, commas, shortest) -> list[float]:
    """Points that paragraphs, and blocks with text of their own, pass upwards."""
    points = [0.0] * len(names)
    for node in range(len(names)):
        if out[node] or length[node] < shortest:
            continue
        own = 1 + commas[node] + min(length[node] // 100, 3)
        up, level = (parents[node] if names[node] in PARAGRAPH else node), 0
        while up >= 0:
            points[up] += own / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = parents[up], level + 1
    return points


def container(names, parents, best: int) -> int:
    """The outermost article or main element around the best node, or the node itself."""
    found, node = best, best
    while node > 0:
        if names[node] in ("article", "main"):
            found = node
        node = parents[node]
    return found


def siblings(names, parents, out, points, length, links, keep: int) -> set[int]:
    """Siblings of the container that score well or read as prose."""
    if keep == 0 or names[keep] in ("article", "main", "body"):
        least = float("inf") if keep == 0 or names[keep] == "body" else max(10.0, 0.2 * points[keep])
    else:
        least = max(10.0, 0.2 * points[keep])
    found = set()
    for node in range(1, len(names)):
        if parents[node] != parents[keep] or node == keep or out[node]:
            continue
        dense = links[node] / max(length[node], 1)
        prose = names[node] == "p" and length[node] > 80 and dense < 0.25
        if points[node] >= least or prose:
            found.add(node)
    return found


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def run(batches):
        for batch in slices(batches, 64):
            texts = [main_text(page) if page else "" for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
