"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each with its path of block-level elements from the
root (class, id and role are part of a step, inline elements are not). Blocks on a path through an element whose tag or
class says that it isn't article text (navigation, adverts, comments and the like) are set aside. For each other path
the ratios of text length and of punctuation to the number of blocks are taken; both are smoothed over neighbouring
blocks in page order and fused by their product. Paths above the threshold are content, and so is all else that stands
in the elements that hold them, such as headings, short paragraphs, lists and tables: the article or main element, or
without one the elements around the paragraphs and what is between these.

Names say less inside an article. There, only classes made up of nothing but the words for adverts, comments and the like
set an element aside at once (``comment-body``, not ``comment-on-prices``); any other named element goes only if its own
ratios are below the threshold too. Names of inline elements, the page, the body and the main element say nothing, those of an
article element only that it is a comment, a teaser or an advert. Names that would set nearly all text aside are passed over, and
so are navigation, footers and other such elements without an end tag, which otherwise would take the rest of the page along.

Reading a page takes time in proportion to its length, however deep its elements are nested.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

#: Elements of HTML by their kind.
RAW = set("script style noscript template iframe object textarea title svg math".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
NO_CONTENT = set("head nav footer aside form button select dialog menu".split())
#: A start tag closes an open element of one of these kinds, up to the nearest of the ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Parts of a class, id or role that mark an element as something other than the article.
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "newsletter subscribe signup sidebar widget menu nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments disqus replies "
    "respond share sharing social related recommended pagination pager login search opinions teaser teasers complementary contentinfo".split()
)
#: Those of them whose text reads like an article's, so that ratios can't tell.
PROSE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr newsletter subscribe signup sidebar "
    "comment comments disqus replies related recommended opinions teaser teasers".split()
)
#: What an article element can be instead of the article.
OTHER_ARTICLES = set("ad advert advertisement sponsored promo comment comments replies related recommended teaser teasers".split())
#: Parts that say nothing about the text, such as in comment-body.
FRAME_NAMES = set(
    "area articles bar block body box button buttons card cards container content field form group header heading inner inline item items link links list "
    "main outer panel post posts reader readers section site slot space stories thread title top unit user users view wrap wrapper".split()
)
#: A class that begins or ends with one of these tells the kind of page, such as no-sidebar or comments-open.
STATES = set("no not without has with is category tag type status format".split())
SWITCHES = set("open closed on off enabled disabled".split())
#: Names of these say nothing.
PAGE = {"html", "body", "main"}
#: What the tag and the names of an element say.
PLAIN, HINTED, TOLD, PROSE, LEFT_OPEN, KIND = range(6)
#: Set aside by the kind of element, whatever names it has.
BY_KIND = 1 << 20
#: If names set aside this share of what kinds don't, they don't tell furniture from text.
NEARLY_ALL = 0.9
#: These mark page furniture unless they stand inside an article.
HEAD_NAMES = {"header"}
#: A path is content if its fused ratio is at least this share of the heaviest path's.
THRESHOLD = 0.2
#: These are parts of a text, so what holds the text is further out. A cell is one only for the words right in it.
LISTS = set("ul ol li dl dt dd blockquote figure figcaption".split())
TABLES = set("table caption colgroup thead tbody tfoot tr td th".split())
#: Characters of a block that is shorter than a sentence.
SHORT = 25
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = ".,;:!?。，、；：！？…"
_PUNCTUATION = re.compile("[" + PUNCTUATION + "]")

_TAG = r"<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
_PLAIN_TAG = r"<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>[^>]*+)>"
_NAMES = r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


class Page:
    """The block-level elements of a page, parents first, and its blocks: (element, text).

    Element 0 is the root. ``path`` numbers the paths of elements; elements with the same steps from the root share one.
    """

    def __init__(self):
        self.parent, self.tag, self.path, self.says, self.in_article = [0], [""], [0], [PLAIN], [False]
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str]] = []

    def element(self, parent: int, tag: str, step: str, says: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[parent], step), len(self.paths) + 1))
        self.says.append(says)
        self.in_article.append(self.in_article[parent] or tag in ("article", "main"))
        return len(self.tag) - 1


class Blocks:
    """Reads pages."""

    def __init__(self):
        self.tags, self.plain, self.names = re.compile(_TAG, re.I), re.compile(_PLAIN_TAG, re.I), re.compile(_NAMES, re.I)
        self.part = re.compile(r"[^a-z0-9]+")
        self.ends = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}

    def _tokens(self, page: str) -> Iterator[tuple[str, str, str]]:
        """(kind, tag or text, attributes) of texts, start tags and end tags; what isn't shown is left out.

        A ``<`` that begins no tag is text. Quotation marks hold a ``>`` unless that leaves a tag without an end.
        """
        at, quoted, last = 0, True, page.rfind(">")
        while (lt := page.find("<", at)) >= 0:
            if lt > at:
                yield "text", page[at:lt], ""
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)
                if end < 0:
                    return
                at = end + 3
                continue
            m = None
            if lt < last:
                m = self.tags.match(page, lt) if quoted else self.plain.match(page, lt)
                if not m and quoted and (m := self.plain.match(page, lt)):
                    quoted = False
            if m:
                tag, at = m["tag"].lower(), m.end()
                if tag in RAW:
                    if not m["end"] and not (tag in ("svg", "math") and m["rest"].endswith("/")):
                        end = self.ends[tag].search(page, at)
                        if not end:
                            return
                        at = end.end()
                else:
                    yield "end" if m["end"] else "start", tag, m["rest"]
            elif lt < last and page[lt + 1] in "!?/":
                at = page.index(">", lt) + 1
            else:
                yield "text", "<", ""
                at = lt + 1
        if at < len(page):
            yield "text", page[at:], ""

    def _says(self, tag: str, rest: str, in_article: bool) -> tuple[str, int]:
        """The step of the element, and what it says by its names."""
        says, named = PLAIN, set()
        for value in self.names.findall(rest) if "=" in rest else ():
            for word in value.lower().strip("\"'").split():
                parts = [p for p in self.part.split(word) if p]
                named.update(parts)
                mine = ASIDE_NAMES.intersection(parts)
                if not parts or parts[0] in STATES or parts[-1] in SWITCHES:
                    continue
                if mine:
                    told = all(p in ASIDE_NAMES or p in FRAME_NAMES or p.isdigit() for p in parts)
                    if tag == "article":
                        says = PROSE if told and mine & OTHER_ARTICLES else says
                    else:
                        says = max(says, (PROSE if mine & PROSE_NAMES else TOLD) if told else HINTED)
                elif not in_article and tag != "article" and HEAD_NAMES.intersection(parts):
                    says = max(says, HINTED)
        return ".".join([tag, *sorted(named)]), PLAIN if tag in PAGE else says

    def __call__(self, page: str) -> Page:
        out = Page()
        stack, held = [0], []
        places: dict[str, list[int]] = {}  # of each tag in the stack

        def flush() -> None:
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.blocks.append((stack[-1], text))

        def cut(k: int, closed: bool = False) -> None:
            for e in reversed(stack[k:]):
                places[out.tag[e]].pop()
                if out.says[e] == KIND and not (closed and e == stack[k]):
                    out.says[e] = LEFT_OPEN
            del stack[k:]

        def nearest(tags: set[str]) -> int:
            return max((places[t][-1] for t in tags if places.get(t)), default=-1)

        for kind, tag, rest in self._tokens(page):
            if kind == "text":
                held.append(tag)
            elif tag in VOID:
                if tag in ("br", "hr"):
                    held.append(" ")
            elif tag in INLINE:
                continue
            elif kind == "end":
                flush()
                if places.get(tag):
                    cut(places[tag][-1], closed=True)
            else:
                flush()
                if out.tag[stack[-1]] == "p":
                    cut(len(stack) - 1)
                if tag in CLOSES:
                    same, ends = CLOSES[tag]
                    if nearest(same) > nearest(ends):
                        cut(nearest(same))
                if not rest.endswith("/"):
                    inside = out.in_article[stack[-1]]
                    step, says = self._says(tag, rest, inside)
                    if tag in NO_CONTENT or tag == "header" and not inside:
                        says = KIND
                    places.setdefault(tag, []).append(len(stack))
                    stack.append(out.element(stack[-1], tag, step, says))
        flush()
        cut(1)
        return out


def _smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian mean over two neighbours on either side."""
    weight = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    return np.convolve(np.pad(x, 2, mode="edge"), weight / weight.sum(), "valid")


def _down(page: Page, first, rule) -> list:
    """A value per element: ``rule(element, value of its parent)``, from ``first`` at the root."""
    out = [first]
    for e in range(1, len(page.tag)):
        out.append(rule(e, out[page.parent[e]]))
    return out


def _homes(page: Page) -> list[int]:
    """For each element the one that holds the text which its blocks are part of: an article, main, or what is around."""
    tag = page.tag
    article = _down(page, 0, lambda e, up: up or (e if tag[e] == "article" else 0))
    main = _down(page, 0, lambda e, up: up or (e if tag[e] == "main" else 0))
    lists = _down(page, 0, lambda e, up: up if tag[e] in LISTS else e)
    tables = _down(page, 0, lambda e, up: up if tag[e] in LISTS or tag[e] in TABLES else e)

    def around(e: int) -> int:
        if tag[e] in TABLES:
            return tables[e]
        return lists[e if tag[e] in LISTS else page.parent[e]]

    return [article[e] or main[e] or around(e) for e in range(len(tag))]


def _set_aside(page: Page) -> tuple[list[int], list[int]]:
    """Per element: how much sets it aside (names each count one, kinds ``BY_KIND``), and the outermost element around it
    whose names leave that to the ratios, or 0."""
    tag, says = page.tag, page.says
    holds = [False] * len(tag)  # elements that hold an article or a title
    for e in range(len(tag) - 1, 0, -1):
        if holds[e] or tag[e] in ("article", "main", "h1"):
            holds[page.parent[e]] = True
    proper = any(t == "article" and says[e] != PROSE for e, t in enumerate(tag))
    inside = _down(page, False, lambda e, up: up or tag[e] == ("article" if proper else "main"))

    def weight(e: int, up: int) -> int:
        if says[e] == KIND:
            return up + (1 if tag[e] == "form" and holds[e] else BY_KIND)
        return up + (says[e] in (PROSE, LEFT_OPEN) or says[e] in (HINTED, TOLD) and not inside[e])

    return _down(page, 0, weight), _down(page, 0, lambda e, up: up or (e if inside[e] and says[e] in (HINTED, TOLD) else 0))


def _passed_over(page: Page, aside: list[int]) -> int:
    """How many names around a block don't set it aside: as few as leave some of the page's text, or its article."""
    tag = page.tag
    sizes: dict[int, int] = {}
    in_article = _down(page, False, lambda e, up: up or tag[e] in ("article", "main"))
    titled = _down(page, False, lambda e, up: up or tag[e] in ("h1", "h2"))
    article = title = prose = BY_KIND
    for e, text in page.blocks:
        if aside[e] < BY_KIND:
            sizes[aside[e]] = sizes.get(aside[e], 0) + len(text)
            article = min(article, aside[e]) if in_article[e] else article
            title = min(title, aside[e]) if titled[e] else title
            prose = min(prose, aside[e]) if len(text) >= SHORT and _PUNCTUATION.search(text) else prose
    total, left = sum(sizes.values()), 0
    for names in sorted(sizes):
        left += sizes[names]
        if left > (1 - NEARLY_ALL) * total or min(article, max(title, prose)) <= names:
            return names
    return 0


def _totals(keyed: list[tuple[tuple[int, int], str]]) -> dict[tuple[int, int], list[float]]:
    """Blocks, characters and punctuation of each key."""
    out: dict[tuple[int, int], list[float]] = {}
    for key, text in keyed:
        t = out.setdefault(key, [0, 0, 0])
        t[0] += 1
        t[1] += len(text)
        t[2] += len(_PUNCTUATION.findall(text))
    return out


def _not_text(page: Page, rest: list[tuple[int, str]], doubt: list[int]) -> set[int]:
    """The elements inside the article whose names and ratios both say that they aren't part of it."""
    totals = _totals([((doubt[e], page.path[e]), text) for e, text in rest])
    ratio = {key: size / n * (marks + 1) / n for key, (n, size, marks) in totals.items()}
    best = max(totals, key=lambda k: (ratio[k] * totals[k][1], k))
    text = {d for (d, _), r in ratio.items() if r >= THRESHOLD * ratio[best]}
    headed = {doubt[e] for e, _ in rest if page.tag[e] in HEADINGS}
    # A sentence such as a call to follow doesn't make a section; a heading with prose does.
    return {d for d, _ in totals if d and not (d in text and (page.says[d] == HINTED or d in headed))}


def content(page: Page) -> list[str]:
    """The texts of the content blocks, in page order."""
    aside, doubt = _set_aside(page)
    names = _passed_over(page, aside)
    rest = [(e, text) for e, text in page.blocks if aside[e] <= names]
    if not rest:
        return []
    out = _not_text(page, rest, doubt)
    rest = [(e, text) for e, text in rest if doubt[e] not in out] or rest
    path, tag, home = page.path, page.tag, _homes(page)
    totals = _totals([(path[e], text) for e, text in rest])
    length = _smooth(np.array([totals[path[e]][1] / totals[path[e]][0] for e, _ in rest]))
    marks = _smooth(np.array([(totals[path[e]][2] + 1) / totals[path[e]][0] for e, _ in rest]))
    score: dict[int, float] = {}
    for (e, _), f in zip(rest, length * marks):
        score[path[e]] = score.get(path[e], 0.0) + float(f) / totals[path[e]][0]
    # A path's weight is what it holds of the page; the heaviest one sets the scale.
    best = max(score, key=lambda p: (score[p] * totals[p][1], p))
    threshold = score[best] * THRESHOLD
    # Neighbours may lift a heading, but not a label: that has no punctuation and a few words at most.
    last_tag = {path[e]: tag[e] for e, _ in rest}
    label = {p for p, (n, size, stops) in totals.items() if not stops and size < SHORT * n and last_tag[p] not in HEADINGS}
    chosen = {p for p, s in score.items() if s >= threshold and (p == best or p not in label)}
    is_text = [path[e] in chosen for e, _ in rest]
    # An article element says where the article is; without one, a text may go on from one element to the next.
    marked = any(path[e] == best and tag[home[e]] in ("article", "main") for e, _ in rest)
    homes = {home[e] for (e, _), t in zip(rest, is_text)
             if t and tag[home[e]] not in ("", "html", "body") and (not marked or tag[home[e]] in ("article", "main"))}
    held = _down(page, False, lambda e, up: up or e in homes)
    if marked:
        return [text for e, text in rest if held[e]]
    first, last = is_text.index(True), len(is_text) - 1 - is_text[::-1].index(True)
    while first and tag[rest[first - 1][0]] in HEADINGS:
        first -= 1
    return [text for k, (e, text) in enumerate(rest) if held[e] or first <= k <= last]


def extract(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in the column ``name`` instead of its HTML.

    Character references are decoded, white space in a block is one space, blocks are joined by one space. A null or
    empty page, and one without content, has an empty text; a page without tags is content. Tags left open and pages cut
    off are read as far as they go; a comment, script or style left open goes to the page's end. Rows stay as they are; another column called ``name`` is an error.
    """
    if name != html_col and name in pages.columns:
        raise ValueError(f"the table already has a column {name}")
    others = [c for c in pages.columns if c != html_col]
    rows = pages.select(F.col(html_col).alias("x"), F.struct(*(others or [F.lit(0)])).alias("row"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks()
        for batch in batches:
            texts = [" ".join(content(blocks(page))) for s in slices(iter([batch]), "x") for page in s.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], schema=pa.schema([("x", pa.string()), batch.schema.field(1)]))

    done = rows.mapInArrow(each, rows.schema)
    return done.select(*(F.col("row")[c].alias(c) for c in others), F.col("x").alias(name))


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


#: For pages whose article is one ``article`` element, as in the test tables.
REPORT_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article[^>]*>(.*?)(</article>|$)', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?(a|b|i|em|span|strong)(\s[^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS x FROM a),
c AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
  '&#x27;', ''''), '&copy;', '©'), '&middot;', '·') AS x FROM b),
d AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(x, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM c)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d
"""
