"""Main text of web pages, by tree scoring.

A page becomes a tree of elements (open ends are closed as browsers do it for the
common cases: paragraphs, list items, table cells, inline markup across blocks).
Elements that never hold article text are left out by tag, role, class or id word;
those only likely to (by word or role, navigation, forms, page headers) stay where a
main element, an article or a first heading lies inside, and words do not count on
a page of which they leave nothing. Every block of running text is
worth a point, one more per comma and per 100 characters; it passes its points to
its ancestors, the full number to its parent and half as much at each further step.
A container's score is the sum of what it got, times the share of its text that is
not in links. The best container is kept, and siblings of it that score a fifth of
it or are running text or headings themselves; where it lies in an article or main
element, that element is the container. Inside, link lists go.

Each page is read whole and by itself, in one pass forward over its markup, one over
its elements and one over its blocks; points go up UP steps at most, so deep pages
cost no more than flat ones. Spark deals the pages; tasks hold one Arrow batch.

Cases: null or empty html, and pages without text, give an empty text; null ids and
urls stay; repeated rows are extracted each; very long and unclosed pages are read to
their end; an empty table gives no rows; other columns are ignored. Of equal scores
the first container on the page wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import ship_package

UP = 5
SIBLING_SHARE = 0.2
LINK_SHARE = 0.5
LEAST_POINTS = 25  # characters of a block that is worth a whole point

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
UNSEEN = RAW | frozenset("head footer aside button select option input label fieldset dialog menu object svg canvas audio video map".split())
MOSTLY_UNSEEN = frozenset("nav form header".split())
BLOCKS = frozenset(
    "html body article main section div header hgroup h1 h2 h3 h4 h5 h6 p pre blockquote ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "figure figcaption address details summary center hr nav footer aside form fieldset dialog menu noscript".split()
)
ENDS_P = BLOCKS - frozenset("html body caption thead tbody tfoot tr td th summary noscript".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("html body table td th caption button object".split())
#: A start tag that ends an open element of these names, up to the nearest container.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
UNSEEN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of a class or id that name what is around an article.
AROUND = frozenset(
    "ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "masthead footer sidebar rail widget widgets cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup paywall login "
    "share sharing social related recommended recommendations pagination pager search toolbar skip outbrain taboola".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())

_MARK = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(!--)|[!?/])")
_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_WITHOUT = frozenset("has with no without".split())
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


class Page:
    """Elements of a page in order; each with its parent, and the pieces of text and elements inside it."""

    def __init__(self) -> None:
        self.tag, self.parent, self.inside, self.attributes = ["html"], [-1], [[]], [""]
        self.open = [0]
        self.places: dict[str, list[int]] = {"html": [0]}  # of each name's open elements
        self.blocks = [0]

    def start(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P:
            self.end({"p"}, SCOPES)
        if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
            self.cut(len(self.open) - 1)
        if tag in CLOSES:
            self.end(*CLOSES[tag])
        number = len(self.tag)
        self.inside[self.open[-1]].append(number)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.inside.append([])
        self.attributes.append(attributes)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.open))
            if tag in BLOCKS:
                self.blocks.append(len(self.open))
            self.open.append(number)

    def cut(self, place: int) -> None:
        """Close the open elements from a place on."""
        for number in self.open[place:]:
            self.places[self.tag[number]].pop()
            if self.tag[number] in BLOCKS:
                self.blocks.pop()
        del self.open[place:]

    def last(self, tags: frozenset[str] | set[str]) -> int:
        if tags is BLOCKS:
            return self.blocks[-1]
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def end(self, tags: frozenset[str] | set[str], stop: frozenset[str] | set[str]) -> None:
        """Close the innermost open element of these names, unless one of ``stop`` lies inside it."""
        place = self.last(tags)
        if place > 0 and place > self.last(stop):
            self.cut(place)

    def text(self, data: str) -> None:
        if data:
            self.inside[self.open[-1]].append(data)


def parse(html: str) -> Page:
    """The page's tree. Comments, declarations and the text of scripts and the like are left out."""
    page, at, size = Page(), 0, len(html)
    last = html.rfind(">")
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            page.text(html[at:mark])
        if mark == size:
            break
        found = _MARK.match(html, mark) if mark < last else None
        after = html[mark + 1 : mark + 2]
        if found is None and not (after.isascii() and after.isalpha() or after in ("/", "!", "?")):
            page.text("<")
            at = mark + 1
            continue
        if found is None:  # the page's end cuts it off, or a quote that stays open
            at = html.find(">", mark) + 1 or size
            close, name, comment = *(_NAME.match(html, mark).groups() if at <= last + 1 and after.isalpha() else (None, None)), None
            attributes = ""
        else:
            close, name, attributes, comment = found.groups()
            at = found.end()
        if comment:
            end = html.find("-->", mark + 2)
            at = size if end < 0 else end + 3
        elif name is None:
            at = html.find(">", mark) + 1 or size
        else:
            tag = name.lower()
            if close:
                page.end({tag}, SCOPES - {tag} if tag in ("p", "li") else frozenset() if tag in BLOCKS else BLOCKS)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = size if end is None else html.find(">", end.start()) + 1 or size
            elif tag not in ("html", "body"):
                page.start(tag, attributes)
    return page


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): next((unescape(v) for v in m.groups()[1:] if v is not None), "") for m in _ATTRIBUTE.finditer(text)}


def _around(tag: str, text: str) -> tuple[bool, bool]:
    """Whether an element is no part of an article: for certain, and unless it holds one."""
    if tag in UNSEEN:
        return True, True
    if not text or text.isspace():
        return False, False
    held = _attributes(text)
    if "hidden" in held or held.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(held.get("style", "")):
        return True, True
    around = held.get("role", "").lower() in UNSEEN_ROLES
    for name in f"{held.get('class', '')} {held.get('id', '')}".split():
        words = [w.lower() for w in _WORD.findall(name)]
        if not words or words[0] in _WITHOUT:
            continue
        if words[0] in COMMENTS or words[-1] in COMMENTS:
            return True, True
        around = around or not AROUND.isdisjoint(words)
    return False, around


def _main(page: Page, i: int) -> bool:
    return page.tag[i] in ("article", "main") or (page.attributes[i] != "" and _attributes(page.attributes[i]).get("role", "").lower() in ("main", "article"))


def _seen(page: Page, by_name: bool) -> list[bool]:
    """Elements that may belong to the article. A page's own headers do not; an article's do.
    Elements named like what is around articles do not either, if ``by_name``."""
    n = len(page.tag)
    marks = [(False, False)] + [_around(page.tag[i], page.attributes[i]) for i in range(1, n)]
    article = [not sure and _main(page, i) for i, (sure, _) in enumerate(marks)]
    within = list(article)
    holds = [a or not sure and page.tag[i] == "h1" and page.tag[page.parent[i]] != "header" for i, (a, (sure, _)) in enumerate(zip(article, marks, strict=True))]
    for i in range(n - 1, 0, -1):
        if holds[i] and not marks[i][0]:
            holds[page.parent[i]] = True
    seen = [True] * n
    for i in range(1, n):
        up = page.parent[i]
        within[i] = within[i] or within[up]
        sure, likely = marks[i]
        likely = likely and by_name or page.tag[i] in MOSTLY_UNSEEN and not (page.tag[i] == "header" and within[i])
        around = sure or likely and not holds[i]
        seen[i] = seen[up] and not around
    return seen


def _blocks(page: Page, seen: list[bool], top: list[int]) -> list[tuple[int, str, int]]:
    """Blocks of text in page order below some elements: innermost block element, text, characters in links."""
    out: list[tuple[int, str, int]] = []
    pieces: list[str] = []
    linked = 0

    def close(block: int) -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((block, text, min(linked, len(text))))
            pieces.clear()
            linked = 0

    for root in top:
        # element, next piece of it, block it belongs to, whether it is in a link
        walk = [[root, 0, root, False]]
        while walk:
            here = walk[-1]
            element, at, block, link = here
            if at == len(page.inside[element]):
                walk.pop()
                if page.tag[element] in BLOCKS or not walk:
                    close(block)
                continue
            here[1] += 1
            piece = page.inside[element][at]
            if isinstance(piece, str):
                plain = unescape(piece) if "&" in piece else piece
                pieces.append(plain)
                linked += len(plain) if link else 0
            elif page.tag[piece] == "br":
                pieces.append(" ")
            elif seen[piece]:
                inner = page.tag[piece] in BLOCKS
                if inner:
                    close(block)
                walk.append([piece, 0, piece if inner else block, link or page.tag[piece] == "a"])
        close(root)
    return out


def _scores(page: Page, blocks: list[tuple[int, str, int]]) -> tuple[list[float], list[int], list[int]]:
    """Score, characters and characters in links of every element."""
    n = len(page.tag)
    points, size, links = [0.0] * n, [0] * n, [0] * n
    for element, text, linked in blocks:
        size[element] += len(text)
        links[element] += linked
        if page.tag[element] in HEADINGS:
            continue
        worth = (min(len(text) / LEAST_POINTS, 1.0) + text.count(",") + len(text) / 100) * (1 - linked / len(text))
        # text directly in a container counts for the container itself
        up = page.parent[element] if page.tag[element] in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote", "figcaption", "caption") else element
        for step in range(UP):
            if up < 0:
                break
            points[up] += worth / 2**step
            up = page.parent[up]
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
        links[page.parent[i]] += links[i]
    return [p * (1 - links[i] / size[i]) if size[i] else 0.0 for i, p in enumerate(points)], size, links


def extract(html: str | None) -> str:
    """The article's blocks, one a line."""
    if not html or html.isspace():
        return ""
    page = parse(html)
    seen = _seen(page, True)
    blocks = _blocks(page, seen, [0])
    if not blocks:  # all of it is named like something else
        seen = _seen(page, False)
        blocks = _blocks(page, seen, [0])
    if not blocks:
        return ""
    score, size, links = _scores(page, blocks)
    n = len(page.tag)
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        best = 0
    container, up = best, best
    while up > 0:
        if _main(page, up):
            container = up
        up = page.parent[up]
    linked = [size[i] > 0 and links[i] > LINK_SHARE * size[i] for i in range(n)]
    keep = {container}
    for i in page.inside[page.parent[container]] if container else []:
        if isinstance(i, int) and seen[i] and size[i] and not linked[i]:
            if score[i] >= SIBLING_SHARE * score[container] > 0 or page.tag[i] in HEADINGS or page.tag[i] in ("p", "pre", "blockquote", "header"):
                keep.add(i)
    lists = [seen[i] and not (linked[i] and page.tag[i] in ("ul", "ol", "div", "section", "table", "dl") and i != container) for i in range(n)]
    return "\n".join(text for _, text, _ in _blocks(page, lists, sorted(keep)))


_TEXT_SQL = "page_id bigint, url string, text string, n_chars bigint"
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html.as_py()) for html in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=_TEXT)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its code points, ``n_chars``, of every page."""
    ship_package(pages.sparkSession)
    kinds = {"page_id": "bigint", "url": "string", "html": "string"}
    return pages.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).mapInArrow(_extracted, _TEXT_SQL)


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: main text of every page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
