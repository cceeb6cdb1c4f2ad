"""Main text of web pages by tag-path ratios (operator 7).

Every text node has a path of tags from the root. Per path, text length, punctuation and number of nodes are added up; a
path with long, punctuated nodes is likely content. Both ratios are smoothed over the nodes in page order and fused,
and paths above the threshold are content paths. The main part is the outermost declared one that holds nearly all of
their weight, else the smallest element that holds all of it, with the title above it. In it all stays but for lists of links
on paths below the threshold, elements that are never content and small ones whose class or id tells that they are around
an article: other short nodes below the threshold are titles and short paragraphs, which belong to the text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfrisk.llm.passages import slices

# Element names by role, and words in class, id or role that mark what surrounds an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("head title style script noscript template nav header footer aside form button select textarea input option "
                  "label fieldset iframe object embed svg canvas math audio video menu dialog datalist output".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div main body html".split())
AROUND = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|banner|breadcrumb|breadcrumbs|comment|comments|consent|"
                    r"cookie|cookies|disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|popup|"
                    r"promo|promoted|recommended|related|replies|respond|share|sharing|sidebar|signup|social|sponsor|sponsored|"
                    r"subscribe|toolbar|widget)(?:$|[\s_-])", re.I)
AROUND_ROLES = frozenset("banner navigation contentinfo complementary search form dialog alert menu menubar toolbar".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")
SMOOTH = np.array([0.06, 0.24, 0.4, 0.24, 0.06])  # over neighbouring nodes
THRESHOLD = 0.5  # of a standard deviation of the fused ratio
MENU = 3  # links in a row, each a block of its own, that make a menu
HOLDS = 0.85  # share of the content weight that a declared main part must hold
WRAPS = 0.5  # share of the text from which an element is a wrapper, whatever its class says


class Node:
    """A text node: its path and element by number, its block, text, whether it can be content and whether it is in a link."""

    __slots__ = ("path", "element", "block", "text", "usable", "linked", "size")

    def __init__(self, path: int, element: int, block: int, text: str, usable: bool, linked: bool = False):
        self.path, self.element, self.block, self.text, self.usable, self.linked = path, element, block, text, usable, linked
        self.size = len(text.strip())


class Page(HTMLParser):
    """Collects text nodes. Elements are numbered from 1 in page order and know their parent, and each different path has one
    number, so a page takes memory in proportion to its length, however deep it nests."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, int]] = []  # name, element number, out, path number
        self.open: dict[str, list[int]] = {}  # places of the open elements of a name on the stack
        self.paths: dict[tuple[int, str], int] = {}
        self.parent = [0]
        self.block = 0
        self.nodes: list[Node] = []
        self.main: set[int] = set()
        self.marked: set[int] = set()
        self.titles: set[int] = set()

    def _cut(self, place: int) -> None:
        """Close the elements from this place of the stack on."""
        for name, *_ in self.stack[place:]:
            self.open[name].pop()
        del self.stack[place:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._end("p", SCOPES - {"div"} | {"blockquote", "td", "th"} if tag != "p" else SCOPES)
            # Formatting left open in the old block goes with it.
            place = len(self.stack)
            while place and self.stack[place - 1][0] in INLINE:
                place -= 1
            self._cut(place)
        if tag in SAME_ENDS:
            place = len(self.stack)
            while place and self.stack[place - 1][0] in SAME_ENDS[tag] | INLINE | {"p"}:
                place -= 1
            self._cut(place)
        if tag not in INLINE:
            self.block += 1
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        self.parent.append(self.stack[-1][1] if self.stack else 0)
        made = len(self.parent) - 1
        given = {k: v or "" for k, v in attrs}
        marks = f"{given.get('class', '')} {given.get('id', '')}"
        out = (bool(self.stack) and self.stack[-1][2] or tag in NEVER or given.get("role", "").lower() in AROUND_ROLES
               or "hidden" in given or given.get("aria-hidden", "").lower() == "true"
               or re.search(r"display\s*:\s*none", given.get("style", ""), re.I) is not None)
        if tag not in ("html", "body", "article", "main") and AROUND.search(marks):
            self.marked.add(made)
        if tag == "h1":
            self.titles.add(made)
        if tag in ("article", "main") or given.get("role", "").lower() in ("main", "article"):
            self.main.add(made)
        above = self.stack[-1][3] if self.stack else 0
        step = above, f"{tag}.{given['class']}" if given.get("class") else tag
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, made, out, self.paths.setdefault(step, len(self.paths) + 1)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("script", "style"):
            self._end(tag, frozenset())

    def _end(self, tag, scopes):
        """Close the innermost open element of that name, unless one of the scopes is open inside it."""
        places = self.open.get(tag)
        if places and not any(self.open.get(s, [-1])[-1:] > places[-1:] for s in scopes):
            self._cut(places[-1])

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.block += 1
        if tag in VOID:
            return
        self._end(tag, frozenset(("td", "th", "table", "article", "body")) - {tag} if tag in INLINE or tag == "p" else frozenset())

    def handle_data(self, data):
        if self.stack:
            _, element, out, path = self.stack[-1]
            self.nodes.append(Node(path, element, self.block, data, not out, bool(self.open.get("a"))))
        else:
            self.nodes.append(Node(0, 0, self.block, data, True))

    def unknown_decl(self, data):
        pass

    def under(self, elements: set[int]) -> list[bool]:
        """For each element whether it is one of these or below one; parents have lower numbers."""
        below = [False] * len(self.parent)
        for e in range(1, len(self.parent)):
            below[e] = e in elements or below[self.parent[e]]
        return below

    def held(self, nodes: list[Node]) -> list[int]:
        """For each element the length of the text in it, added up from the leaves to the root once."""
        total = [0] * len(self.parent)
        for node in nodes:
            total[node.element] += node.size
        for e in range(len(self.parent) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total

    def above(self, element: int):
        """The elements around one, from the inside out."""
        while element := self.parent[element]:
            yield element


def closed(html: str) -> str:
    """Comments and tags that the page never ends are text; looking for their ends again and again would take the square of its length."""
    end = html.rfind("-->") + 3 if "-->" in html else 0
    html = html[:end] + html[end:].replace("<!--", "&lt;!--")
    end = html.rfind(">") + 1
    return html[:end] + html[end:].replace("<", "&lt;")


def fused_ratios(nodes: list[Node]) -> np.ndarray:
    """Per node: smoothed length times smoothed punctuation ratio of its path."""
    sums: dict[int, list[int]] = {}
    for node in nodes:
        total = sums.setdefault(node.path, [0, 0, 0])
        total[0] += node.size
        total[1] += len(PUNCTUATION.findall(node.text))
        total[2] += 1
    length = np.array([sums[n.path][0] / sums[n.path][2] for n in nodes])
    points = np.array([(1 + sums[n.path][1]) / sums[n.path][2] for n in nodes])
    smooth = [np.convolve(np.pad(v, 2, mode="edge"), SMOOTH, mode="valid") for v in (length, points)]
    return np.sqrt(smooth[0] * smooth[1])


def content_paths(nodes: list[Node]) -> set[int]:
    """Paths whose nodes have, on average, a ratio above the threshold; at least the best path."""
    fused = fused_ratios(nodes)
    sums: dict[int, list[float]] = {}
    for node, ratio in zip(nodes, fused):
        total = sums.setdefault(node.path, [0.0, 0])
        total[0] += ratio
        total[1] += 1
    means = {path: total / n for path, (total, n) in sums.items()}
    least = min(fused.mean() + THRESHOLD * fused.std(), max(means.values()))
    return {path for path, mean in means.items() if mean >= least}


def around(page: Page) -> set[int]:
    """Marked elements that are out. One with much of the text is a wrapper whose class only tells what else the page has,
    unless a declared main part lies outside of all marked elements."""
    usable = [n for n in page.nodes if n.usable]
    size, total = page.held(usable), sum(n.size for n in usable)
    marked, main = page.under(page.marked), page.under(page.main)
    outside = sum(n.size for n in usable if main[n.element] and not marked[n.element])
    return {e for e in page.marked if size[e] < WRAPS * total or outside > (1 - HOLDS) * total}


def main_text(html: str) -> str:
    """The blocks of the main part joined by line feeds."""
    page = Page()
    page.feed(closed(html))
    page.close()
    out = page.under(around(page)) if page.marked else None
    nodes = [n for n in page.nodes if n.usable and not (out and out[n.element])]
    filled = [n for n in nodes if n.size]
    if not filled:
        return ""
    paths = content_paths(filled)
    chosen = [n for n in filled if n.path in paths]
    weight, total = page.held(chosen), sum(n.size for n in chosen)
    # Elements are numbered in page order, so the innermost of nested ones has the highest number.
    best = max((e for e in range(1, len(weight)) if weight[e] >= total), default=None)
    declared = [e for e in page.main if weight[e] and weight[e] >= HOLDS * total]
    if declared:
        best = min(declared)
    elif best is not None:
        # An inline element or single paragraph is not the main part: take the element around the content blocks.
        inside = page.under({best})
        if len({n.block for n in chosen if inside[n.element]}) == 1 and page.parent[best]:
            best = page.parent[best]
        # The title may stand above the content, with a lead: the element that holds all of them, if it adds little.
        titled = page.under(page.titles)
        named = page.held([n for n in filled if titled[n.element]])
        if not named[best]:
            size = page.held(filled)
            higher = next((e for e in page.above(best) if named[e]), None)
            if higher is not None and size[best] >= HOLDS * size[higher]:
                best = higher
    inside = page.under({best}) if best is not None else None
    blocks, last = [], None
    for node in nodes:
        if inside and not inside[node.element]:
            continue
        if node.block != last:
            blocks.append([])
            last = node.block
        blocks[-1].append(node)
    lines = [(b, t) for b, t in ((b, " ".join("".join(n.text for n in b).split())) for b in blocks) if t]
    return "\n".join(t for (_, t), menu in zip(lines, _menus([b for b, _ in lines], paths)) if not menu)


def _menus(blocks: list[list[Node]], paths: set[int]) -> list[bool]:
    """Which blocks belong to a list of links: MENU or more in a row that are links throughout, on paths that are not content."""
    plain = [all((n.linked and n.path not in paths) or not n.size for n in b) for b in blocks]
    out = []
    for same, group in groupby(plain):
        size = len(list(group))
        out += [same and size >= MENU] * size
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every whole page.

    NULL, empty and text-free pages give an empty text. Rows stand alone; repeated pages, NULL ids and further columns
    change nothing.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h) if h else "" for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
