"""Main text of web pages by tag-path ratios.

A page is read once, tag by tag, into text nodes with their path of tags from the root. Per path, the text length,
the number of nodes and the punctuation are added up. A path's ratio is its text per node, weighed by its punctuation
per node: running text is long and punctuated, menus and labels are neither. Ratios are laid out over the
nodes in page order, smoothed with a Gaussian window, and fused with the path's own ratio; paths whose fused value
passes a threshold are content. The smallest container that holds the text of all content paths then decides what
else belongs to it: headings and short blocks inside it stay, and everything outside goes. Only where a page marks its ``main``
part and more than half of the content's text lies there, text elsewhere is foreign whatever its path. 

What is never article text goes before any counting, by three signs. By its tag: menus, footers, sidebars, forms, scripts and the
like, and headers, except that the header of an article or main part stays where it holds a heading, since that is the article's title. By its
attributes, read one by one as browsers do: ``role``, ``hidden``, a style of ``display:none``, and classes and ids whose parts
all name such a thing or its shape (``comment-list``, ``ad-slot``, ``cookie-bar``; not ``no-comments`` or ``ad-hoc``). A name does not count on an
element that holds most of the page's punctuated text, unless it is one of comments, consent or adverts and the page has other text. And by
structure, whatever the names: two or more neighbours of the same tag and classes that come last, hold less than half of the
punctuated text, and all carry the same short label (such as "Reply") are entries of readers.

A page takes time in proportion to its length and number of tags, however deep they nest: paths are numbered in a tree, and what an
element holds is a range of numbers.

Rows are independent; pages stream through in Arrow batches, and no page meets another.

Defined results: null and empty pages, and pages without text, give an empty text of length 0; broken markup
(unclosed or stray tags, pages cut off) is read as far as it goes; equal rows give equal rows; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from recordloom.llm.common import table

# Elements of the HTML standard by how they are treated here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
SKIP = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea input label iframe object svg "
    "canvas audio video dialog menu fieldset".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINER = frozenset("article body div main section td html center".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot html body".split())
PEERS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}
# Words for what stands beside an article; the first ones are foreign even where there is more of it than of the article.
FOREIGN = frozenset(
    "ad ads adv advert advertisement advertisements adverts advertising sponsor sponsored promo promotion cookie cookies consent gdpr comment comments commentlist "
    "commentary disqus replies respond".split()
)
BESIDE = FOREIGN | frozenset(
    "banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead notice popup modal overlay share sharing social related "
    "recommended newsletter subscribe signup login search pagination pager widget widgets toolbar hidden".split()
)
# words that only say where such a thing stands or what shape it has
SHAPE = frozenset(
    "site page main global top bottom left right side reader readers user users list lists thread threads slot slots bar box boxes section area wrapper wrap "
    "container block unit item items inner outer holder zone region panel group module strip link links button buttons icon icons form count feed tree row col "
    "posts articles stories".split()
)
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# quotes hold a value together only behind an equals sign
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]*+)|[\"'])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]*+)))?")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^\W\d_a-zA-Z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？¿¡]")
SPACE = re.compile(r"\s+")

SIGMA = 1.0
MAIN_SHARE = 0.5  # of the content's text must lie in main elements for others to be foreign
LABEL_CHARS = 24  # a label that entries share is no longer


def attributes(text: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


def unwanted(given: dict[str, str]) -> bool:
    """Whether an element is never article text, by what its attributes say of its use."""
    if given.get("role", "").strip().lower() in SKIP_ROLES or "hidden" in given:
        return True
    return given.get("aria-hidden", "").strip().lower() == "true" or "display:none" in "".join(given.get("style", "").split()).lower()


def beside(name: str) -> frozenset[str]:
    """The words of a class or id that name something beside the article, if the others only tell its place or shape."""
    parts = [p.lower() for p in PARTS.findall(name)]
    named = BESIDE.intersection(parts)
    return named if named and all(p in BESIDE or p in SHAPE or p.isdigit() for p in parts) else frozenset()


class Page:
    """Text nodes of a page in order, and its elements by number, in order of their start.

    An element holds the elements numbered from its own to ``end`` and the nodes from ``first`` to before ``after``.
    """

    def __init__(self, page: str):
        self.text: list[str] = []
        self.path: list[int] = []
        self.block: list[int] = []
        self.container: list[int] = []  # the innermost container of a node, 0 for none
        self.parent = [0]  # of an element: the element around it
        self.around = [0]  # of an element: the innermost container around it
        self.look = [("", "")]  # tag and classes
        self.first, self.after, self.end = [0], [0], [0]
        self.named: dict[int, bool] = {}  # elements that are named like something beside the article: is it foreign?
        self.headers: dict[int, bool] = {}  # headers of article and main: is there a heading in it?
        self.paths: dict[tuple[int, str], int] = {}
        self.in_main = [False]
        self.read(page)

    def read(self, page: str) -> None:
        stack: list[tuple[str, bool, int, int, int]] = []  # tag, unwanted, number, path, container
        open_tags: dict[str, int] = {}
        marks: list[int] = []  # open elements that are named or headers
        last: dict[int, int] = {}  # the last node by innermost of these
        block, at, skipped = 0, 0, 0

        def text(raw: str) -> None:
            if skipped or not raw:
                return
            if raw.isspace():
                space()
                return
            last[marks[-1] if marks else 0] = len(self.text)
            self.text.append(html.unescape(raw))
            self.path.append(stack[-1][3] if stack else 0)
            self.container.append(stack[-1][4] if stack else 0)
            self.block.append(block)

        def space() -> None:
            i = last.get(marks[-1] if marks else 0)
            if not skipped and i is not None and self.block[i] == block:
                self.text[i] += " "

        def close(index: int) -> None:
            nonlocal skipped
            for tag, bad, number, _, _ in reversed(stack[index:]):
                skipped -= bad
                open_tags[tag] -= 1
                self.after[number], self.end[number] = len(self.text), len(self.parent) - 1
                if marks and marks[-1] == number:
                    marks.pop()
            del stack[index:]

        def close_up_to(peers: tuple[str, ...], stop: frozenset[str] | tuple[str, ...]) -> None:
            if not any(open_tags.get(p) for p in peers):
                return
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in peers:
                    close(i)
                    return
                if stack[i][0] in stop:
                    return

        while at < len(page):
            m = TAG.search(page, at)
            if m is None:
                text(page[at:])
                break
            text(page[at : m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag in BLOCK:
                block += 1
            if m[1]:
                # an inline end tag does not reach out of its block
                close_up_to((tag,), () if tag in BLOCK else BLOCK)
                continue
            if tag == "br":
                space()
            if tag in VOID:
                continue
            if tag in CLOSES_P:
                close_up_to(("p",), BLOCK)
            if tag in PEERS:
                peers, stop = PEERS[tag]
                close_up_to(tuple(peers.split()), stop)
            if m[3].endswith("/") and tag not in BLOCK:
                continue
            given = attributes(m[3]) if m[3] and tag not in ("body", "html", "article", "main") else {}
            own_header = tag == "header" and (open_tags.get("article", 0) or open_tags.get("main", 0))
            bad = (tag in SKIP and not own_header) or unwanted(given)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if not bad:
                    text(page[at : end.start() if end else len(page)])
                at = end.end() if end else len(page)
                continue
            number = len(self.parent)
            above, container = (stack[-1][3], stack[-1][4]) if stack else (0, 0)
            path = self.paths.setdefault((above, tag), len(self.in_main))
            if path == len(self.in_main):
                self.in_main.append(tag == "main" or self.in_main[above])
            self.parent.append(stack[-1][2] if stack else 0)
            self.around.append(container)
            self.look.append((tag, given.get("class", "")))
            self.first.append(len(self.text))
            self.after.append(len(self.text))
            self.end.append(number)
            stack.append((tag, bad, number, path, number if tag in CONTAINER else container))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            skipped += bad
            words = frozenset().union(*(beside(n) for key in ("class", "id") for n in given.get(key, "").split()))
            if words:
                self.named[number] = not FOREIGN.isdisjoint(words)
            if own_header:
                self.headers[number] = False
            if words or own_header:
                marks.append(number)
            if tag in HEADINGS and self.headers:
                for n in reversed(marks):
                    if n in self.headers:
                        self.headers[n] = True
                        break
        close(0)
        self.end[0], self.after[0] = len(self.parent) - 1, len(self.text)

    def covered(self, elements) -> list[bool]:
        """Of each node: does it stand in one of the elements?"""
        change = [0] * (len(self.text) + 1)
        for n in elements:
            change[self.first[n]] += 1
            change[self.after[n]] -= 1
        depth, out = 0, []
        for c in change[:-1]:
            depth += c
            out.append(depth > 0)
        return out

    def sums(self, sizes: list[int]) -> list[int]:
        out = [0]
        for x in sizes:
            out.append(out[-1] + x)
        return out

    def size_in(self, total: list[int], element: int) -> int:
        return total[self.after[element]] - total[self.first[element]]

    def kept(self) -> list[int]:
        """Nodes outside elements that stand beside the article by their name, or by their structure."""
        gone = self.covered([n for n, heading in self.headers.items() if not heading])
        foreign = [n for n, alien in self.named.items() if alien]
        punctuated = [len(t) if PUNCTUATION.search(t) else 0 for t in self.text]

        def outside(besides, sizes: list[int]) -> list[int]:
            hidden = [g or h for g, h in zip(gone, self.covered(besides))]
            total = self.sums([0 if h else s for h, s in zip(hidden, sizes)])
            named = [n for n in self.named if 2 * self.size_in(total, n) <= total[-1]]
            out = [g or c for g, c in zip(gone, self.covered(named))]
            return [i for i, dropped in enumerate(out) if not dropped]

        left = outside(foreign, punctuated) or outside((), [len(t) for t in self.text])
        entries = self.covered(self.entries(left, punctuated))
        return [i for i in left if not entries[i]]

    def entries(self, left: list[int], punctuated: list[int]) -> list[int]:
        """Neighbours alike that come last and all carry the same short label: what readers wrote."""
        here = [False] * len(self.text)
        for i in left:
            here[i] = True
        total = self.sums([p if h else 0 for p, h in zip(punctuated, here)])
        count = self.sums([int(h) for h in here])
        children: dict[tuple[int, str, str], list[int]] = {}
        for n in range(1, len(self.parent)):
            if self.look[n][0] in ("li", "div", "article", "section", "tr", "blockquote", "dd") and count[self.after[n]] > count[self.first[n]]:
                children.setdefault((self.parent[n], *self.look[n]), []).append(n)
        out: list[int] = []
        for alike in children.values():
            size = sum(self.size_in(total, n) for n in alike)
            if len(alike) < 2 or not size or 2 * size >= total[-1]:
                continue
            # all of the page's other running text stands before them, or outside their parent
            parent = self.parent[alike[0]]
            if total[self.after[parent]] > total[self.after[alike[-1]]]:
                continue
            shared: set[str] | None = None
            for n in alike:
                labels = {
                    t for i in range(self.first[n], self.after[n])
                    if here[i] and not punctuated[i] and (t := " ".join(self.text[i].lower().split())) and len(t) <= LABEL_CHARS
                }
                shared = labels if shared is None else shared & labels
                if not shared:
                    break
            if shared and total[self.first[alike[0]]] > 0:
                out += alike
        return out


def content_paths(page: Page, nodes: list[int]) -> set[int]:
    """Tag paths whose smoothed and fused ratio passes the threshold."""
    length: dict[int, int] = {}
    count: dict[int, int] = {}
    marks: dict[int, int] = {}
    for i in nodes:
        path, text = page.path[i], page.text[i]
        length[path] = length.get(path, 0) + len(text)
        count[path] = count.get(path, 0) + 1
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
    ratio = {p: length[p] / count[p] * math.log(2 + marks[p] / count[p]) for p in length}
    series = [ratio[page.path[i]] for i in nodes]
    window = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in (-2, -1, 0, 1, 2)]
    fused: dict[int, float] = {}
    for k, i in enumerate(nodes):
        path = page.path[i]
        pairs = [(w, series[k + d]) for w, d in zip(window, (-2, -1, 0, 1, 2), strict=True) if 0 <= k + d < len(series)]
        smooth = sum(w * v for w, v in pairs) / sum(w for w, _ in pairs)
        fused[path] = fused.get(path, 0.0) + math.sqrt(smooth * series[k]) / count[path]
    mean = sum(fused.values()) / len(fused)
    spread = math.sqrt(sum((v - mean) ** 2 for v in fused.values()) / len(fused))
    threshold = min(spread, max(fused.values()))
    return {p for p, v in fused.items() if v >= threshold}


def main_text(html_text: str | None) -> str:
    """The article of a page; blocks in page order, joined by an empty line."""
    page = Page(html_text or "")
    nodes = page.kept()
    if not nodes:
        return ""
    paths = content_paths(page, nodes)
    content = [i for i in nodes if page.path[i] in paths]
    marked = [i for i in content if page.in_main[page.path[i]]]
    if sum(len(page.text[i]) for i in marked) > MAIN_SHARE * sum(len(page.text[i]) for i in content):
        content = marked
    low, high = (f(page.container[i] for i in content) for f in (min, max))
    best = page.container[content[0]]
    # containers are numbered in order of their start, so the first around both ends holds all
    while best and not (best <= low and high <= page.end[best]):
        best = page.around[best]
    blocks: dict[int, list[str]] = {}
    for i in nodes:
        if not best or best <= page.container[i] <= page.end[best]:
            blocks.setdefault(page.block[i], []).append(page.text[i])
    joined = (SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n\n".join(b for b in joined if b)


SCHEMA = "page_id long, url string, text string, n_chars long"


def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column("html")]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    chosen = df.selectExpr(f"cast(`{id_col}` as long) as page_id", f"`{url_col}` as url", f"`{html_col}` as html")
    return chosen.mapInArrow(extract, SCHEMA)


def op10(spark, sf: str) -> DataFrame:
    return extract_main_text(table(spark, sf, "pages"))
