"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser streams events; each block (paragraph, heading, list item,
cell and the like) becomes a line with its characters and the tags since the line before.
A line's ratio is characters per tag, and 0 for page furniture. The logarithms of the ratios,
or what a Gaussian makes of them and their neighbours where that is more, are split into two
clusters by the threshold of least variance inside them; as many zeros as there are lines
stand for furniture, so that a page of text alone is not split. The lines of the upper cluster
point out the content region: the innermost article (or main) element that holds all of them,
else the innermost container of several lines that does, else the page. All lines of that
region but furniture are the text, short ones included. So what is left out is furniture, and
lines short for their page outside the smallest region of all the others.

Furniture is told by element, by role, by hidden marks and by words in class and id.

Null and empty pages, and pages without content, have the empty text. A page is parsed
whole, however long, in time that grows with its length, also where elements nest deeply or
stay open. Declarations of unknown kinds are comments. Equal pages get equal texts; every row
gives a row, so repeated ids stay repeated, an empty table gives an empty one, and other columns
of the table are left out whatever their names. Equal values of the two clusters' border go below it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.texts import column

# Kinds of HTML elements, and the words that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead
    tr ul""".split()
)
FURNITURE = frozenset(
    """aside button datalist dialog footer form head header iframe label menu nav noscript object option script
    select style svg template textarea title""".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
MARKS = frozenset(
    """ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie
    cookies copyright disclaimer disqus footer form header login masthead menu modal nav navbar navigation newsletter
    notice notices notification pager pagination popup promo promoted promotion related replies sidebar share sharing
    signup social sponsor sponsored subscribe toolbar""".split()
)
NEGATIONS = frozenset("has no with without".split())
REGIONS = frozenset("article main".split())
CONTAINERS = frozenset("center div section td".split())
#: Elements that a later start tag of the same group ends.
ENDED_BY = {
    "p": BLOCK,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
}
ENDS = {tag: [ended for ended, by in ENDED_BY.items() if tag in by] for tag in {t for by in ENDED_BY.values() for t in by}}
#: Elements that such an implied end does not reach beyond.
WALLS = frozenset("table ul ol dl div section article main body select".split())
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
TAG_START = re.compile(r"<[A-Za-z/!?]")

SIGMA = 1.0


def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    if tag in FURNITURE:
        return True
    if tag in ("html", "body") or tag in REGIONS:
        return False
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name in ("class", "id"):
            words = [w.lower() for w in WORD.findall(value)]
            if any(w in MARKS and words[max(0, k - 1)] not in NEGATIONS for k, w in enumerate(words)):
                return True
    return False


class _Lines(HTMLParser):
    """Lines of a page: text, tags before and in it, innermost open element, furniture or not.

    Elements are numbered as they open, so those inside element n, and no others, have the
    numbers from n to ``last[n]``; -1 is the page. Every step costs the same however deep the page is.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, number of the element, furniture
        self.places: dict[str, list[int]] = {}  # tag -> where in ``open`` it is
        self.names: list[str] = []
        self.parents: list[int] = []
        self.last: list[int] = []
        self.lines: list[tuple[str, int, int, bool]] = []
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            _, number, furniture = self.open[-1] if self.open else ("", -1, False)
            self.lines.append((text, self.tags, number, furniture))
            self.tags = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Where a section ``<![...`` ends; all but CDATA are comments up to the next ``>``, as in browsers."""
        end = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        at = self.rawdata.find(end, i + 3)
        return at + len(end) if at >= 0 else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag in BLOCK
        marked = _marked(tag, attrs)
        if block or marked:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        for ended in ENDS.get(tag, ()):
            self._end(ended, WALLS)
        if tag in VOID:
            return
        _, parent, furniture = self.open[-1] if self.open else ("", -1, False)
        number = len(self.names)
        self.names.append(tag)
        self.parents.append(parent)
        self.last.append(-1)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, number, marked or furniture))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, "/>" ends void elements only

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        self._end(tag, frozenset() if tag in ("body", "html") else frozenset({"body"}))

    def _end(self, tag: str, walls: frozenset[str]) -> None:
        """End the innermost open element of this name, and all inside it, unless a wall is between."""
        at = self._place(tag)
        if at < 0 or any(self._place(wall) > at for wall in walls):
            return
        if any(t in BLOCK or marked for t, _, marked in self.open[at:]):
            self.flush()
        self._close(at)

    def _place(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def _close(self, at: int) -> None:
        while len(self.open) > at:
            tag, number, _ = self.open.pop()
            self.places[tag].pop()
            self.last[number] = len(self.names) - 1

    def finish(self) -> None:
        self.close()
        self.flush()
        self._close(0)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    reach = int(np.ceil(2 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratios, reach), kernel / kernel.sum(), "valid")


def _upper_cluster(values: np.ndarray) -> np.ndarray:
    """Marks of the values above the threshold with the least variance inside the two clusters."""
    order = np.sort(values)
    n = len(order)
    if n == 1 or order[0] == order[-1]:
        return np.ones(n, bool)
    total, squares = np.cumsum(order), np.cumsum(order**2)
    k = np.arange(1, n)
    inside = squares[:-1] - total[:-1] ** 2 / k + (squares[-1] - squares[:-1]) - (total[-1] - total[:-1]) ** 2 / (n - k)
    inside[order[1:] == order[:-1]] = np.inf
    at = int(inside.argmin())
    return values > (order[at] + order[at + 1]) / 2


def main_text(html: str | None) -> str:
    if not isinstance(html, str) or not html:
        return ""
    parser = _Lines()
    cut_off = TAG_START.search(html, html.rfind(">") + 1)  # a tag that the page's end cuts off is no text
    parser.feed(html[: cut_off.start()] if cut_off else html)
    parser.finish()
    lines = parser.lines
    usable = [k for k, line in enumerate(lines) if not line[3]]
    if not usable:
        return ""
    ratios = np.log1p([0.0 if furniture else len(text) / max(1, tags) for text, tags, _, furniture in lines])
    values = np.maximum(ratios, _smoothed(ratios))
    content = _upper_cluster(np.concatenate([values, np.zeros(len(lines))]))
    seeds = [k for k in usable if content[k]] or usable
    owners = np.array([lines[k][2] for k in usable])
    first, final = min(lines[k][2] for k in seeds), max(lines[k][2] for k in seeds)
    holders = []  # elements around all seeds, innermost first
    number = first
    while number >= 0:
        if parser.last[number] >= final:
            holders.append(number)
        number = parser.parents[number]
    inside = np.sort(owners)

    def held(n: int) -> int:
        """Usable lines in element n."""
        return int(np.searchsorted(inside, parser.last[n], "right") - np.searchsorted(inside, n, "left"))

    # of nested regions the innermost, else the innermost container of several lines, else the page
    regions = (n for n in holders if parser.names[n] in REGIONS)
    several = (n for n in holders if parser.names[n] in CONTAINERS and held(n) > 1)
    region = next(regions, None)
    if region is None:
        region = next(several, None)
    if region is None:
        return "\n\n".join(lines[k][0] for k in usable)
    return "\n\n".join(lines[k][0] for k in usable if region <= lines[k][2] <= parser.last[region])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: the id, the url, text and n_chars."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"text": [main_text(h) for h in batch]})

    found = pages.select(pages[id_col], pages[url_col], column(run, "text string", pages[html_col]).alias("__result"))
    text = F.col("__result.text")
    return found.select(id_col, url_col, text.alias("text"), F.length(text).cast("long").alias("n_chars"))
