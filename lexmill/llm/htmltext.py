"""HTML extraction (operator 9): the main text of a page.

A page is read as a stream of standard-library parser events and cut into lines, one for
each block of text.  Each line has a text-to-tag ratio: the characters outside links for
each tag since the line before.  The ratios, smoothed by a Gaussian, are clustered by a
threshold into content and other lines, and the content cluster selects what is kept:

* the region: the articles that hold content lines, if together they hold ``share`` of the
  content text, and of that of the main part around them; else the main part, if it holds
  ``share``; else the smallest container that holds every content line;
* articles inside another region are cards that lead elsewhere, and go, if their first line is a
  link or none of their lines is in the cluster;
* inside a region that is neither article nor main part, runs of lines that are links and
  nothing else, outside the cluster, are menus and go;
* a container whose class or id merely contains a word for something beside the content
  (``related-work``), or calls it a menu, goes only if none of its lines is in the cluster by its
  own ratio.

Other lines of the region stay, also short ones with a low ratio, but for those in elements
that the markup itself names as something else: menus, headers, footers, sidebars, notices,
adverts, forms, and what isn't shown.  So do reader comments, however long they are: any
container whose class or id speaks of comments or replies.

Time is linear in the length of a page, however deep or broken it is.

Defined results: a null or empty page gives the empty text, as does one without text;
broken markup is read leniently (a block's start ends an open paragraph, unclosed inline
tags end with their block, stray end tags are skipped); white space, also a no-break space,
becomes one space; pages of any length are read whole; repeated rows each give a row; an
empty table gives no rows; a column of the input named as the output column is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import words

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
SKIP = frozenset("head title script style noscript template textarea select option button svg annotation iframe object canvas audio video".split())
ASIDE = frozenset("nav header footer aside form dialog menu search".split())
REGION = frozenset("article main section div body td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Words of a class or id that mark what isn't content.
MARKS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer header masthead menu nav navbar navigation newsletter notice notices pager pagination popup modal promo promoted related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: Words beside them that leave the mark as it is.
NEUTRAL = frozenset("area bar block bottom box card container content form global group head inner item items left link links list main overlay page panel post posts right row section site slot top unit wrap wrapper zone".split())
#: Words beside which a header is that of the content.
TITLED = frozenset("article entry post story content title".split())
#: Of the marks, those that count for an article too: each comment may be one.
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
_COMMENTS = re.compile(r"comment(?!ar|at|ed|ing)|^repl(?:y|ies)$|^respond$|disqus")
#: Words beside which a comment's mark is a state or a count.
STATES = frozenset("has no open closed off on disabled with without count counter number link allowed".split())
#: Marks that prose overrules.
MENUS = frozenset("menu menubar".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_WHITE = re.compile(r"\s+")
_COMMENT_END = re.compile(r"--!?>")
_OPENER = re.compile(r"<[A-Za-z/!?]")
#: So many lines of nothing but links, one after another, are a menu.
MENU = 3


@dataclass(frozen=True, slots=True)
class Line:
    text: str
    tags: int  # since the line before
    linked: int  # characters of links
    container: int
    aside: bool
    hint: int  # the outermost container with a doubtful mark, or -1


class _Lines(HTMLParser):
    """Cuts a page into lines of text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, bool, int]] = []  # tag, container, aside, skipped, hint
        self.at: dict[str, list[int]] = defaultdict(list)  # where in it each tag is
        self.blocks: list[int] = []  # and the blocks
        self.parents, self.tags = [-1], ["html"]
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.seen = self.linked = self.hints = 0

    def _state(self) -> tuple[int, bool, bool, int]:
        return self.open[-1][1:] if self.open else (0, False, False, -1)

    def _flush(self) -> None:
        if self.parts:
            if text := _WHITE.sub(" ", "".join(self.parts)).strip():
                container, aside, _, hint = self._state()
                self.lines.append(Line(text, self.seen, min(self.linked, len(text)), container, aside, hint))
                self.seen = 0
            self.parts, self.linked = [], 0

    def _last(self, *tags: str) -> int:
        """The place of the innermost open one of the tags, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def _pop_to(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.open.pop()[0]
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.seen += 1
        if tag in BLOCK:
            if tag != "br" and (head := self._last("head")) >= 0:  # that wasn't closed
                self._pop_to(head)
            self._flush()
            if tag != "br":
                self._close_open("p", ("button", "table", "td", "th"))
                for other in _CLOSES.get(tag, ()):
                    self._close_open(other, _SCOPE[tag])
        if tag in VOID:
            return
        container, aside, skipped, hint = self._state()
        if not aside and (tag in ASIDE or attrs):
            mark = self._mark(tag, attrs)
            aside = mark == "named"
            if mark == "doubtful" and hint < 0:
                hint, self.hints = self.hints, self.hints + 1
        skipped = skipped or tag in SKIP
        if tag in REGION:
            self.parents.append(container)
            self.tags.append("main" if tag == "main" or dict(attrs).get("role") == "main" else tag)
            container = len(self.parents) - 1
        self.at[tag].append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append((tag, container, aside, skipped, hint))

    def _mark(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        """Whether the markup names the element as something beside the content, or may do so."""
        if tag in ASIDE and not (tag == "header" and self.at.get("article")):
            return "named"
        for name, value in attrs:
            if name in ("hidden", "inert") or name == "role" and value in ROLES or name == "aria-hidden" and value == "true" or name == "style" and value and _HIDDEN.search(value):
                return None if tag in ("html", "body", "main") else "named"
        if tag in ("html", "body", "main") or tag in HEADING:
            return None
        marks, doubtful = COMMENTS if tag == "article" else MARKS, False
        for name, value in attrs:
            if value and (name == "class" or name == "id" and tag in BLOCK and tag != "p"):
                for token in value.split():
                    own = [w.lower() for w in _WORDS.findall(token)]
                    if tag in BLOCK and tag not in ("p", "article") and any(map(_COMMENTS.search, own)) and not STATES.intersection(own):
                        return "named"
                    if MENUS.intersection(own) and all(w in MENUS or w in NEUTRAL or w.isdigit() for w in own):
                        doubtful = tag in BLOCK and tag != "p"
                        if doubtful:
                            continue
                    if any(w in marks and not (w == "header" and TITLED.intersection(own)) for w in own):
                        if all(w in MARKS or w in NEUTRAL or w.isdigit() for w in own):
                            return "named"
                        doubtful = tag in BLOCK and tag != "p"
        return "doubtful" if doubtful else None

    def _close_open(self, tag: str, scope: tuple[str, ...]) -> None:
        """Ends the innermost open ``tag``, unless a scope or container began inside it."""
        at = self._last(tag)
        if at >= 0 and at > self._last(*scope, *(REGION - {tag})):
            self._pop_to(at)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # in HTML the slash is ignored, but in drawings
        if tag in ("svg", "math", "path", "use"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.seen += 1
        if tag in BLOCK:
            self._flush()
        at = self._last(tag)
        # an inline end tag doesn't leave its block
        if at >= 0 and (tag in BLOCK or not self.blocks or at > self.blocks[-1]):
            self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if not self._state()[2]:
            self.parts.append(data)
            if self.at.get("a"):
                self.linked += len(data.strip())

    def parse_comment(self, i: int, report: bool = True) -> int:
        """The end of a comment; of one that never ends only the opener is skipped."""
        if i < self.unended:
            if end := _COMMENT_END.search(self.rawdata, i + 4):
                return end.end()
            self.unended = i
        return i + 4

    def parse_html_declaration(self, i: int) -> int:
        """The end of a declaration or marked section, whatever stands in it."""
        return self.rawdata.find(">", i) + 1

    def read(self, html: str) -> list[Line]:
        """The lines of a whole page."""
        # what begins after the last > never ends: without it no search runs to the end of the page twice
        cut = html.rfind(">") + 1
        self.unended = len(html)
        self.feed(html[:cut])
        self.close()
        if not self.cdata_elem:
            self.handle_data(unescape(_OPENER.split(html[cut:], maxsplit=1)[0]))
        self._flush()
        return self.lines


def _smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    """A Gaussian mean of each value and its neighbours, weighed anew at the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(x, kernel)[reach : reach + len(x)]
    return full / np.convolve(np.ones(len(x)), kernel)[reach : reach + len(x)]


def ratios(lines: list[Line]) -> np.ndarray:
    """Characters outside links for each tag."""
    return np.array([0.0 if x.aside else (len(x.text) - x.linked) / max(1, x.tags) for x in lines])


def content_lines(lines: list[Line], sigma: float, threshold: float) -> np.ndarray:
    """Which lines the smoothed text-to-tag ratios put into the content cluster."""
    ratio = ratios(lines)
    smooth = _smooth(ratio, sigma)
    return (smooth >= threshold * smooth.std()) & (ratio > 0)


def _regions(page: _Lines, content: np.ndarray, share: float) -> tuple[set[int], bool]:
    """The containers whose lines are the region, and whether the markup calls them so."""
    weight = np.zeros(len(page.parents))
    for line, kept in zip(page.lines, content, strict=True):
        weight[line.container] += len(line.text) * bool(kept)
    for i in range(len(weight) - 1, 0, -1):
        weight[page.parents[i]] += weight[i]
    outer = [False] * len(weight)  # inside an article already
    for i in range(1, len(weight)):
        outer[i] = outer[page.parents[i]] or page.tags[page.parents[i]] == "article"
    articles = {i for i, tag in enumerate(page.tags) if tag == "article" and not outer[i] and weight[i] > 0}
    main = max((i for i, tag in enumerate(page.tags) if tag == "main"), key=lambda i: weight[i], default=None)
    own, whole = sum(weight[i] for i in articles), weight[0]
    if main is not None and weight[main] >= share * whole:
        below = [False] * len(weight)
        for i in range(1, len(weight)):
            below[i] = page.parents[i] == main or below[page.parents[i]]
        within = sum(weight[i] for i in articles if below[i])
        return (articles, True) if articles and within >= share * weight[main] and own >= share * whole else ({main}, True)
    if articles and own >= share * whole:
        return articles, True
    return {max(i for i in range(len(weight)) if weight[i] >= whole)}, False


def _cards(page: _Lines, content: np.ndarray, region: set[int]) -> set[int]:
    """The lines of articles inside a region that lead elsewhere."""
    outer: list[int] = []  # of each container the outermost article around it, below the region, or -1
    for i, tag in enumerate(page.tags):
        above = outer[page.parents[i]] if i else -1
        outer.append(-1 if i in region else above if above >= 0 else i if tag == "article" else -1)
    lines: dict[int, list[int]] = defaultdict(list)
    for i, line in enumerate(page.lines):
        if outer[line.container] >= 0 and not line.aside:
            lines[outer[line.container]].append(i)
    first = lambda own: page.lines[own[0]]
    return {i for own in lines.values() if first(own).linked >= len(first(own).text) or not content[own].any() for i in own}


def _menus(lines: list[Line], content: np.ndarray) -> set[int]:
    """The lines of runs of nothing but links, outside the content cluster."""
    out: set[int] = set()
    run: list[int] = []
    for i, (line, kept) in enumerate(zip(lines, content, strict=True)):
        if not kept and line.linked >= len(line.text) and (not run or lines[run[-1]].container == line.container):
            run.append(i)
            continue
        out.update(run if len(run) >= MENU else ())
        run = []
    return out | set(run if len(run) >= MENU else ())


def extract(html: str | None, sigma: float = 1.0, threshold: float = 1.0, share: float = 2 / 3) -> str:
    """The main text of a page, one block a line."""
    if not html:
        return ""
    page = _Lines()
    lines = page.read(html)
    if not lines:
        return ""
    content = content_lines(lines, sigma, threshold)
    if not content.any():
        content = np.array([not x.aside for x in lines])
    region, called = _regions(page, content, share)
    inside = [False] * len(page.parents)
    for i in range(len(inside)):
        inside[i] = i in region or i > 0 and inside[page.parents[i]]
    gone = _cards(page, content, region) | (set() if called else _menus(lines, content))
    # what a neighbour's ratio smooths up doesn't decide a doubtful mark
    own = ratios(lines)
    high = own >= threshold * own.std()
    meant = {x.hint for x, kept in zip(lines, content & high, strict=True) if kept}
    return "\n".join(x.text for i, x in enumerate(lines) if inside[x.container] and not x.aside and i not in gone and (x.hint < 0 or x.hint in meant))


def _texts(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    for batch in words.sliced(batches, at):
        out = pa.array([extract(x) for x in batch.column(at).to_pylist()], pa.string())
        rest = [c for i, c in enumerate(batch.columns) if i != at]
        yield pa.RecordBatch.from_arrays([*rest, out], names=[*(f"c{i}" for i in range(len(rest))), "text"])


def extract_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Replaces the column ``html`` of each row by the main text, named ``text``."""
    names = [c for c in pages.columns if c in (html,) or c != text]
    pages = pages.select(*(F.col(f"`{c}`") for c in names))
    at = names.index(html)
    rest = [f for i, f in enumerate(pages.schema) if i != at]
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(rest)] + [T.StructField("text", T.StringType())])
    return pages.mapInArrow(lambda it: _texts(it, at), schema).toDF(*(f.name for f in rest), text)
