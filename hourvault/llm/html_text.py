"""Main text of web pages: parser events, text-to-tag ratios per line, Gaussian smoothing and threshold clustering."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hourvault.llm.common import map_rows
from hourvault.llm.registry import query, table

#: Width of the Gaussian over lines, and the share of all content that a region must hold to be looked into.
SIGMA, REACH = 1.0, 2
MAIN_SHARE = 0.75
#: Lists, tables and boxes with this share of link characters are menus, outside of articles.
LINK_SHARE = 0.5

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var td th").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag of the same list ends, if no element of `bounds` stands between.
IMPLIED = {tag: (ends.split(), bounds.split()) for tags, ends, bounds in (
    ("li", "li", "ul ol menu"), ("dt dd", "dt dd", "dl"), ("tr", "tr td th", "table"), ("td th", "td th", "table tr"),
    ("tbody thead tfoot", "tbody thead tfoot tr td th", "table"), ("option optgroup", "option optgroup", "select"))
    for tag in tags.split()}
# What is no main text, by element, role, and words in class and id.
CHROME_TAGS = frozenset(("head title script style noscript template nav footer aside form button select textarea iframe object svg canvas "
                         "audio video dialog").split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
CHROME_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "signup login search share sharing social related recommended pagination pager toolbar widget").split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
NEGATIONS = ("no-", "has-", "with-", "without-", "no_", "has_", "with_", "without_")

OPEN, CHROME, CLOSED = 0, 1, 2
RESULT = "page_id bigint, url string, text string, n_chars bigint"
_UNFINISHED = re.compile(r"<[A-Za-z/!?]")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def names_in(value: str) -> set[str]:
    """Lower-case words in the names of a class or id attribute; names like has-sidebar tell of something else."""
    return {w.lower() for name in value.split() if not name.lower().startswith(NEGATIONS) for w in _PARTS.findall(name)}


class Lines(HTMLParser):
    """Lines of a page from the events of a streaming parser: text, tags since the line before, link characters, region.

    A line is the text of one block. Regions are the block elements, as a tree. Open elements of one name are found in
    one step, so that time is linear in the page also where tags are crossed or never closed.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, int]] = []  # tag, state, region, place of the block that it stands in
        self.places: dict[str, list[int]] = {}
        self.parents, self.kinds = [-1], [""]
        self.text: list[str] = []
        self.size: list[int] = []
        self.tags: list[int] = []
        self.links: list[int] = []
        self.region: list[int] = []
        self.heading: list[bool] = []
        self.parts: list[str] = []
        self.seen = self.link = 0
        self.titled = False

    def state(self) -> int:
        return self.open[-1][1] if self.open else OPEN

    def here(self) -> int:
        return self.open[-1][2] if self.open else 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            self.text.append(text)
            self.size.append(len(text))
            self.tags.append(self.seen)
            self.links.append(self.link)
            self.region.append(self.here())
            self.heading.append(self.titled)
            self.seen = 0
        self.parts, self.link = [], 0

    def pop_to(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop()[0]].pop()

    def innermost(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.seen += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr":
                self.end_line()
            return
        block = tag not in INLINE
        if tag in ("td", "th"):
            self.parts.append(" ")
        if block:
            self.end_line()
            place = self.innermost("p")  # a block ends an open paragraph, if that stands in no closer block
            if place >= 0 and place == self.block_place():
                self.pop_to(place)
        if tag in IMPLIED:
            ends, bounds = IMPLIED[tag]
            place = min((p for p in map(self.innermost, ends) if p > max(map(self.innermost, bounds))), default=-1)
            if place >= 0:
                self.pop_to(place)
        state = self.judged(tag, attrs)
        region, inside = self.here(), self.block_place()
        if block:
            region, inside = len(self.parents), len(self.open)
            self.parents.append(self.here())
            self.kinds.append(tag)
            self.titled = tag in HEADINGS
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, state, region, inside))

    def block_place(self) -> int:
        return self.open[-1][3] if self.open else -1

    def judged(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        state = self.state()
        if state == CLOSED:
            return CLOSED
        words = set()
        if attrs and tag not in ("html", "body"):
            for name, value in attrs:
                if name in ("class", "id") and value:
                    words |= names_in(value)
                elif name == "role" and value and value.strip().lower() in CHROME_ROLES:
                    return CLOSED
        if tag in CHROME_TAGS or words & COMMENT_WORDS and tag != "main":
            return CLOSED
        if tag == "header":
            return state if self.innermost("article") >= 0 or self.innermost("main") >= 0 else CLOSED
        if tag in ("main", "article"):
            return OPEN
        return CHROME if words & CHROME_WORDS else state

    def handle_endtag(self, tag: str) -> None:
        self.seen += 1
        place = self.innermost(tag)
        if tag in INLINE:
            if place > self.block_place():
                self.pop_to(place)
            return
        self.end_line()
        if place >= 0:
            self.pop_to(place)
        self.titled = bool(self.open) and self.open[-1][0] in HEADINGS

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections like <![CDATA[ are comments in HTML."""
        return self.parse_bogus_comment(i, 0)

    def finish(self) -> None:
        """Markup that the page's end cuts off goes, as browsers have it; the parser would read it again from each mark."""
        if _UNFINISHED.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.end_line()

    def handle_data(self, data: str) -> None:
        if self.state() == OPEN:
            self.parts.append(data)
            if self.innermost("a") >= 0:
                self.link += len(data)


def content_lines(size: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines are content: their text-to-tag ratio, smoothed over neighbours, reaches the deviation of all ratios."""
    ratio = size / np.maximum(tags, 1)
    kernel = np.exp(-np.arange(-REACH, REACH + 1) ** 2 / (2 * SIGMA ** 2))
    smooth = np.convolve(np.pad(ratio, REACH), kernel / kernel.sum(), "valid")
    return smooth >= min(smooth.std(), smooth.max(initial=0.0))


def main_region(lines: Lines, chars: np.ndarray) -> int:
    """The region to read: down from the page to the innermost one that holds most content, or an article on the way.

    `chars` are the content characters of each region with all below. A heading that stands beside the region, under
    the same parent, belongs to it: the parent is read then.
    """
    children: dict[int, int] = {}
    for k in range(1, len(lines.parents)):  # of each region's children that with the most content, the first on ties
        p = lines.parents[k]
        if p not in children or chars[k] > chars[children[p]]:
            children[p] = k
    path = [0]
    while path[-1] in children and chars[children[path[-1]]] >= MAIN_SHARE * max(chars[0], 1):
        path.append(children[path[-1]])
    for wanted in ("article", "main"):
        for k in path:
            if lines.kinds[k] == wanted:
                return k
    while len(path) > 1 and lines.kinds[path[-1]] not in ("body", "html", "div", "section", "td", ""):
        path.pop()
    titles = {lines.parents[r] for r, h in zip(lines.region, lines.heading, strict=True) if h}
    if len(path) > 2 and path[-1] not in titles and path[-2] in titles:
        path.pop()
    return path[-1]


def main_text(html: str) -> str:
    """Main text of a page: the blocks of its main region, one a line."""
    lines = Lines()
    lines.feed(html)
    lines.finish()
    if not lines.text:
        return ""
    size, region = np.array(lines.size), np.array(lines.region)
    content = content_lines(size, np.array(lines.tags))
    parents = lines.parents
    chars, total, links = (np.bincount(region, weights, len(parents)) for weights in (size * content, size, np.array(lines.links)))
    for k in range(len(parents) - 1, 0, -1):  # parents come before their children
        for sums in (chars, total, links):
            sums[parents[k]] += sums[k]
    top = main_region(lines, chars)
    inside = np.zeros(len(parents), bool)
    inside[top] = True
    for k in range(top + 1, len(parents)):
        menu = total[k] and links[k] >= LINK_SHARE * total[k] and lines.kinds[k] in ("ul", "ol", "div", "section", "table", "menu")
        inside[k] = inside[parents[k]] and not (menu and lines.kinds[top] not in ("article", "main"))
    return "\n".join(t for t, r in zip(lines.text, lines.region, strict=True) if inside[r])


def page_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars (code points); no shuffle.

    A parser's events cut a page into lines, one for each block; menus, page headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and reader comments never get into a line, by their element, role, class or id.
    Text-to-tag ratios of the lines, smoothed by a Gaussian, are clustered by a threshold into content and others. The
    region that holds most of the content is read in whole, so its headings and short paragraphs stay.

    White space within a block, in Unicode's sense, becomes one space; character references are decoded; blocks are
    joined by line feeds in page order. Null and empty pages, and pages without text, give an empty text. Repeated
    rows get a row each, null ids and urls stay null, and an empty table gives no rows; other columns are not read.
    """
    def run(batch: pa.RecordBatch) -> dict:
        found = [main_text(h) if h else "" for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": found, "n_chars": [len(t) for t in found]}

    return map_rows(pages.selectExpr(f"CAST(`{id_column}` AS BIGINT) AS page_id", f"`{url_column}` AS url", f"`{html_column}` AS html"), run, RESULT)


# The given pages keep their text in one <article> of headings and paragraphs, which SQL can cut out.
HTML_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(x, '</?(p|h[1-6])>'), lambda y:
        trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(replace(y, '<br>', ' '), '<[^>]*>', '', 'g'),
          '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a)
SELECT page_id, url, array_to_string(list_filter(blocks, lambda y: y <> ''), chr(10)) AS text,
       CAST(length(array_to_string(list_filter(blocks, lambda y: y <> ''), chr(10))) AS BIGINT) AS n_chars
FROM b
"""


@query("op13_page_text", HTML_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_texts(table(spark, sf_dir, "pages"))
