"""Main text of web pages by composite text density.

A page is read into a tree: tags that HTML lets authors leave open are closed where it says so, raw
elements (scripts, styles) and comments are not part of it. Parts whose element, role, class or id
says that they are menus, headers, footers, sidebars, notices, adverts, forms or reader comments are
taken out; a form, class or id says so only of nodes that are not the frame of an article or of most of
the text beside links, nor an article's header with its title. Some words are doubtful, as they also name what a
text is about (``share`` in ``market-share``): beside a part of the name that is neither such a word nor one of layout,
or on an element of running text, they count only where at least half of the text are links. For every node left, with characters C, tags T, link characters LC and link tags LT below it,

    density = C / T * log(C * T / (LC * LT)) to the base ln(C * LC / (C - LC) + C * LCb / Cb + e)

(b: body; zeros count as one), so text with few tags is dense and links make it thin. The node whose
children's densities have the largest sum is the core. The threshold is the least density on the
path from body to it. Where ``article`` or ``main`` elements are around the core, the outermost of them is the result
as a whole (density has chosen it, the threshold decides nothing inside), and so are articles beside it that are as
dense as the threshold. Without one the result is the core together with whatever beside that path is as dense as the
threshold, or is a heading, paragraph, list or table that is not mostly links; thin lists of links in it are left out.

Null and empty pages give an empty text. Pages are read one by one, so repeated rows get equal texts;
null ids stay; other columns pass through, those with the names of result columns are replaced. Work is
linear in the page, however deep it is nested.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakemodels.llm.common import map_rows
from lakemodels.llm.plans import PLANS, read

# Element names by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template svg math object canvas noframes xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
TEXT_BLOCKS = set("h1 h2 h3 h4 h5 h6 p blockquote pre ul ol dl table figure".split())
LISTS = set("ul ol dl div section table menu".split())
# Open elements that a start tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PARTS = set("nav aside footer form button select dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = set(
    "nav navbar navigation menu sidebar aside footer header masthead banner notice notices cookie cookies consent gdpr "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond "
    "related recommended share sharing social breadcrumb breadcrumbs pagination pager newsletter subscribe subscription "
    "popup modal overlay login signup widget toolbar alert skip".split()
)
# Words that also name the layout of a page, so that a frame around the whole page can bear them.
LAYOUT = set("nav navbar navigation menu sidebar aside footer header masthead banner toolbar overlay widget skip".split())
# Words that also name what a text is about, and words that only say how such a part is laid out.
DOUBTFUL = set("share sharing social related recommended respond alert notice notices promotion subscription consent header menu skip".split())
PLAIN = set(
    "area bar block body box button buttons card cards container content frame group icon icons inner item items layout left link "
    "links list main outer page panel post posts right row section site slot text title top bottom unit wrap wrapper".split()
)
RUNNING = set("p h1 h2 h3 h4 h5 h6 blockquote pre table figure li dt dd td".split())
MODIFIERS = {"has", "with", "no", "without"}
FREE = {"html", "body", "article", "main"}
# Marks of nodes: taken out if mostly links; to be taken out; unless it is a frame; unless it is a frame that holds the
# title or main.
LINKS, OUT, FRAME, PART = 1, 2, 3, 4
# Elements that can hold others of their name, though nothing in them is text of the page.
NESTED = set("template svg math object".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+>|[^>]*(?:>|\Z))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_SPLIT = re.compile(r"[-_\s]+|(?<=[a-z])(?=[A-Z])")


class Page:
    """The tree of a page: nodes in page order, so that a parent comes before its children."""

    def __init__(self, source: str):
        self.tags = ["html"]
        self.parents = [-1]
        self.marks = [0]
        # Events in page order: (node, text) for text, (node, None) for a line break or an edge of a block.
        self.events: list[tuple[int, str | None]] = []
        # Articles whose class or id says that they are no part of the text.
        self.side: set[int] = set()
        self.open = [0]
        self.at: dict[str, list[int]] = {"html": [0]}
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = _TAG.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                self.events.append((self.open[-1], html.unescape(source[at:stop])))
            if not found:
                break
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                self._close(name)
            elif name in RAW:
                if not found[3].endswith("/>"):
                    at = _after(source, name, at)
            else:
                self._start(name, found[3])

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self.at.get(name):
            return
        if name in ENDS:
            ended, beyond = ENDS[name]
            self._end_nearest(ended, beyond)
        if name in BLOCKS and self.at.get("p"):
            self._end_nearest({"p"}, {"td", "th", "button", "caption", "object"})
        if name == "br":
            self.events.append((self.open[-1], " "))
            return
        node = len(self.tags)
        self.tags.append(name)
        self.parents.append(self.open[-1])
        self.marks.append(self._mark(name, attributes))
        if name == "article" and self._mark("div", attributes):
            self.side.add(node)
        if name in BLOCKS:
            self.events.append((node, None))
        if name not in VOID:
            self.open.append(node)
            self.at.setdefault(name, []).append(node)

    def _mark(self, name: str, attributes: str) -> int:
        if name in PARTS and name != "form":
            return OUT
        if name == "header" and not (self.at.get("article") or self.at.get("main")):
            return OUT
        mark = FRAME if name == "form" else 0
        if name in FREE or len(attributes) < 4:
            return mark
        for key, *values in _ATTRIBUTE.findall(attributes):
            value, key = "".join(values), key.lower()
            if key in ("class", "id"):
                mark = max(mark, self._named(name, value))
            elif key == "role":
                if value.lower() == "form":
                    mark = max(mark, FRAME)
                elif value.lower() in ROLES:
                    return OUT
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                return OUT
            elif key == "style" and _HIDDEN.search(value):
                return OUT
        return mark

    def _named(self, name: str, value: str) -> int:
        """The mark that the names in a class or id give."""
        mark, within = 0, bool(self.at.get("article") or self.at.get("main"))
        for token in value.split():
            parts, before = [part.lower() for part in _SPLIT.split(token) if part], ""
            doubt = name in RUNNING or not all(part in WORDS or part in PLAIN or part.isdigit() for part in parts)
            for part in parts:
                if part in WORDS and before not in MODIFIERS:
                    if doubt and part in DOUBTFUL and (within or part not in LAYOUT):
                        mark = max(mark, LINKS)
                    else:
                        mark = max(mark, FRAME if part in LAYOUT else PART)
                before = part
        return mark

    def _noise(self, link: list[bool]) -> list[bool]:
        """Nodes that are taken out: marked ones and all below, but not the frames of the page's text."""
        n, tags, parents, marks = len(self.tags), self.tags, self.parents, self.marks
        noise = [m > LINKS for m in marks]
        if LINKS in marks:
            texts, linked = [0] * n, [0] * n
            for node, text in self.events:
                if text:
                    size = len("".join(text.split()))
                    texts[node] += size
                    linked[node] += size * link[node]
            for i in range(n - 1, 0, -1):
                texts[parents[i]] += texts[i]
                linked[parents[i]] += linked[i]
                noise[i] = noise[i] or (marks[i] == LINKS and 2 * linked[i] >= texts[i])
        if FRAME in marks or PART in marks or self.side:
            out, held, titles, articles = [m == OUT for m in marks], [0] * n, [0] * n, [0] * n
            within = [t in ("article", "main") for t in tags]
            for i in range(1, n):
                out[i] = out[i] or out[parents[i]]
                within[i] = within[i] or within[parents[i]]
            for node, text in self.events:
                if text and not out[node] and not link[node]:
                    held[node] += len("".join(text.split()))
            for i in range(n - 1, 0, -1):
                if not out[i]:
                    p = parents[i]
                    held[p] += held[i]
                    titles[p] += titles[i] + (tags[i] in ("h1", "main"))
                    articles[p] += articles[i] + (tags[i] in ("article", "main"))
            for i in range(1, n):
                # An article's own header holds its title.
                title = marks[i] == FRAME and titles[i] > 0 and within[i]
                frame = articles[i] > 0 or 2 * held[i] > held[0]
                if marks[i] > OUT and (title or (frame and (marks[i] == FRAME or titles[i] > 0))):
                    noise[i] = False
            # Of several articles those with such a name go, unless they hold the title or most of the text.
            if any(tags[i] in ("article", "main") and i not in self.side for i in range(n)):
                for i in self.side:
                    noise[i] = noise[i] or not (titles[i] or 2 * held[i] > held[0])
        for i in range(1, n):
            noise[i] = noise[i] or noise[parents[i]]
        return noise

    def _end_nearest(self, ended: set[str], beyond: set[str]) -> None:
        last = max((self.at[t][-1] for t in ended if self.at.get(t)), default=-1)
        if last > max((self.at[t][-1] for t in beyond if self.at.get(t)), default=-1):
            self._pop_to(last)

    def _close(self, name: str) -> None:
        if name in ("html", "body") or not self.at.get(name):
            return
        node = self.at[name][-1]
        if name not in BLOCKS and any(self.tags[n] in BLOCKS for n in self._above(node)):
            return
        self._pop_to(node)

    def _above(self, node: int):
        """Open nodes inside the one given; stops early at the first block, which decides."""
        for n in reversed(self.open):
            if n == node:
                return
            yield n

    def _pop_to(self, node: int) -> None:
        while True:
            last = self.open.pop()
            self.at[self.tags[last]].pop()
            if self.tags[last] in BLOCKS:
                self.events.append((self.parents[last], None))
            if last == node:
                return

    def text(self) -> str:
        """The main text: blocks in page order, an empty line between them."""
        n = len(self.tags)
        tags, parents = self.tags, self.parents
        link = [t == "a" for t in tags]
        for i in range(1, n):
            link[i] = link[i] or link[parents[i]]
        noise = self._noise(link)
        chars, link_chars, below, links = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.events:
            if text and not noise[node]:
                size = len("".join(text.split()))
                chars[node] += size
                if link[node]:
                    link_chars[node] += size
        for i in range(n - 1, 0, -1):
            if not noise[i]:
                p = parents[i]
                chars[p] += chars[i]
                link_chars[p] += link_chars[i]
                below[p] += below[i] + 1
                links[p] += links[i] + (tags[i] == "a")
        if not chars[0]:
            return ""
        body = self.at["body"][0] if self.at.get("body") else 0
        if not chars[body]:
            body = 0
        share = link_chars[body] / (chars[body] or 1)
        density = [0.0 if noise[i] else _density(chars[i], below[i], link_chars[i], links[i], share) for i in range(n)]
        sums = [0.0] * n
        for i in range(1, n):
            sums[parents[i]] += density[i]
        inside = [False] * n
        inside[body] = True
        for i in range(1, n):
            inside[i] = inside[i] or (inside[parents[i]] and not noise[i])
        core = max((i for i in range(n) if inside[i]), key=lambda i: (sums[i], -i))
        path = [core]
        while path[-1] != body:
            path.append(parents[path[-1]])
        threshold = min(density[i] for i in path)
        kept = self._kept(path, density, threshold, chars, link_chars, noise)
        thin = [False] * n
        if not any(tags[i] in ("article", "main") for i in path):
            for i in range(1, n):
                thin[i] = thin[parents[i]] or (
                    tags[i] in LISTS and links[i] > 1 and 5 * link_chars[i] >= 4 * chars[i] and density[i] < threshold
                )
        return self._blocks(kept, thin, noise)

    def _kept(self, path, density, threshold, chars, link_chars, noise) -> list[bool]:
        """Nodes whose subtree belongs to the result, before thin lists of links are left out."""
        tags, parents, n = self.tags, self.parents, len(self.tags)
        kept = [False] * n
        around = [i for i in path if tags[i] in ("article", "main")]
        on_path = set(path)
        if around:
            kept[around[-1]] = True
            for i in range(1, n):
                beside = tags[i] == "article" and parents[i] == parents[around[-1]] and i not in self.side
                kept[i] = kept[i] or (beside and not noise[i] and density[i] >= threshold)
        for i in range(1, n):
            p = parents[i]
            if kept[p] and not noise[i]:
                kept[i] = True
            elif not around and p in on_path and not noise[i] and chars[i]:
                mostly_links = 2 * link_chars[i] > chars[i]
                kept[i] = (i == path[0]) or (
                    i not in on_path and not mostly_links and (density[i] >= threshold or tags[i] in TEXT_BLOCKS)
                )
        if not around:
            # Text that stands in the path's nodes themselves, and in inline elements there.
            for i in path:
                kept[i] = True
            for i in range(1, n):
                if not kept[i] and not noise[i] and tags[i] not in BLOCKS and kept[parents[i]]:
                    kept[i] = True
        return kept

    def _blocks(self, kept, thin, noise) -> str:
        blocks: list[str] = []
        parts: list[str] = []
        for node, text in [*self.events, (0, None)]:
            if text is None:
                block = " ".join("".join(parts).split())
                if block:
                    blocks.append(block)
                parts = []
            elif kept[node] and not noise[node] and not thin[node]:
                parts.append(text)
        return "\n\n".join(blocks)


def _after(source: str, name: str, at: int) -> int:
    """The place after the end tag of an element whose content is not read."""
    edge, depth = re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE), 1
    while found := edge.search(source, at):
        at = found.end()
        if found[1]:
            depth -= 1
        elif name in NESTED and not found[0].endswith("/>"):
            depth += 1
        if not depth:
            return at
    return len(source)


def _density(chars: int, below: int, link_chars: int, links: int, share: float) -> float:
    if not chars:
        return 0.0
    plain = (chars - link_chars) or 1
    # The base is near 1 only in empty bodies; the logarithm of a base is kept away from zero.
    base = max(math.log(math.log(chars / plain * link_chars + share * chars + math.e)), 1e-4)
    thick = chars / (link_chars or 1) * ((below or 1) / (links or 1))
    return chars / (below or 1) * math.log(max(thick, 1.0)) / base


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return Page(source).text() if source else ""


ADDED = "text string, n_chars long"


def extracted(pages: DataFrame, source: str = "html") -> DataFrame:
    """Add ``text``, the main text of the page, and ``n_chars``, its code points."""
    new = StructType.fromDDL(ADDED)
    kept = pages.drop(*[c for c in pages.columns if c.lower() in new.names and c != source])
    names = [c for c in kept.columns if c != source]

    def start():
        def work(part):
            out = {name: part[name] for name in names}
            out["text"] = [main_text(page) for page in part[source]]
            out["n_chars"] = [len(text) for text in out["text"]]
            return out

        return work

    fields = [f for f in kept.schema.fields if f.name != source]
    return map_rows(kept, StructType(fields + new.fields), start)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    return extracted(read(spark, sf_dir, "pages").select("page_id", "url", "html"))


PLANS["op8_html"] = op8_html
