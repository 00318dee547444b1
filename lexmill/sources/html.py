"""Markup as tables: the nodes of a page, and the blocks that the parsers of the plans read.

The only code that walks a document tree.  It runs in Arrow batches, one page after
another; a page that can't be read gives a row with ``error`` instead of failing its task.

Markup is read leniently: void elements, implied ends of paragraphs, list items, table
cells, rows and options, stray end tags skipped, open tags closed at the end.  The text of
scripts, styles and comments is no text of the elements around them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_IMPLIED = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "pre", "post", "depth")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0
        self.pre = self.post = 0

    def walk(self) -> Iterator[Node]:
        """This node and those below it, in document order."""
        stack: list[Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[tuple[Node, str]]:
        """Texts with the nodes that hold them, without those of scripts and styles below this node."""
        stack: list[tuple[Node, int]] = [(self, 0)]
        while stack:
            node, at = stack.pop()
            for i in range(at, len(node.children)):
                child = node.children[i]
                if isinstance(child, str):
                    yield node, child
                elif child.tag not in ("script", "style", "template"):
                    stack += [(node, i + 1), (child, 0)]
                    break

    def raw(self) -> str:
        return "".join(text for _, text in self.strings())

    def text(self) -> str:
        """The stripped strings, joined by spaces."""
        return " ".join(s for _, text in self.strings() if (s := text.strip()))

    def find(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n is not self and n.tag in tags]

    def above(self, *tags: str) -> Node | None:
        node = self.parent
        while node and node.tag not in tags:
            node = node.parent
        return node

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node:
            yield node
            node = node.parent

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def class_matches(self, pattern: re.Pattern) -> bool:
        return any(pattern.search(c) for c in self.classes) or bool(pattern.search(self.attrs.get("class", "")))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._end({"p"}, {"button", "td", "th", "table", "div", "section", "article"})
        if tag in _IMPLIED:
            self._end(*_IMPLIED[tag])
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent or self.root

    def _end(self, tags: set[str], scope: set[str]) -> None:
        node: Node | None = self.at
        while node and node.parent and node.tag not in scope:
            if node.tag in tags:
                self.at = node.parent
                if tags != {"td", "th", "tr"}:
                    return
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        node: Node | None = self.at
        while node and node.parent:
            if node.tag == tag:
                self.at = node.parent
                return
            node = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str) -> Node:
    """The tree of a page, numbered in document order before and after the children."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    count = 0
    stack: list[tuple[Node, bool]] = [(builder.root, False)]
    while stack:
        node, done = stack.pop()
        if done:
            node.post = count
        else:
            node.pre = count
            stack.append((node, True))
            stack += [(c, False) for c in reversed(node.children) if isinstance(c, Node)]
        count += 1
    return builder.root


# --- nodes ---------------------------------------------------------------------------

NODES = "node_pre int, node_post int, parent_pre int, depth int, sibling int, tag string, node_id string, classes array<string>, attrs map<string,string>, text string, error string"


def _nodes(html: str) -> Iterator[dict]:
    for node in parse(html).walk():
        siblings = [c for c in node.parent.children if isinstance(c, Node)] if node.parent else [node]
        yield {
            "node_pre": node.pre,
            "node_post": node.post,
            "parent_pre": node.parent.pre if node.parent else None,
            "depth": node.depth,
            "sibling": siblings.index(node),
            "tag": node.tag,
            "node_id": node.attrs.get("id"),
            "classes": node.classes,
            "attrs": list(node.attrs.items()),
            "text": " ".join(s for c in node.children if isinstance(c, str) and (s := c.strip())),
        }


def html_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per element, with the text that it holds itself; ``node_pre`` and ``node_post`` nest as the elements do."""
    return _flat(pages, html, NODES, _nodes)


TREE = "node_pre int, node_post int, parent_pre int, depth int, tag string, node_id string, classes array<string>, attrs map<string,string>, text string, error string"


def _tree(html: str) -> Iterator[dict]:
    root, count, opened = parse(html), 0, {}
    stack: list[tuple[Node | str, int | None, bool]] = [(root, None, False)]
    while stack:
        node, at, done = stack.pop()
        if isinstance(node, str):
            yield {"node_pre": count, "node_post": count, "parent_pre": at, "depth": opened[at]["depth"] + 1, "tag": "#text", "text": node}
        elif done:  # with its own number
            yield opened.pop(at) | {"node_post": count}
        else:
            opened[count] = {"node_pre": count, "parent_pre": at, "depth": node.depth, "tag": node.tag, "node_id": node.attrs.get("id"), "classes": node.classes, "attrs": list(node.attrs.items())}
            stack.append((node, count, True))
            stack += [(c, count, False) for c in reversed(node.children)]
        count += 1


def html_tree(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per element and one per text (``#text``), numbered together in document order, for structural joins."""
    return _flat(pages, html, TREE, _tree)


# --- blocks --------------------------------------------------------------------------

BLOCKS = (
    "kind string, ord int, part int, tag string, node_id string, heading string, text string, text_plain string, context string, raw string, "
    "chapter string, headers array<string>, cells array<string>, attrs map<string,string>, error string"
)
#: Kinds: page, section, table_row, list_item, heading, code, documentation, rate_block, rate_link, link, form_field, field, string.
# Selectors of sections, the first that finds any counts; of main content, documentation and rates.
_SECTION_TESTS: tuple[Callable[[Node], bool], ...] = (
    lambda n: n.tag == "div" and "paragraf" in n.classes,
    lambda n: n.tag == "div" and "paragraf-innhold" in n.classes,
    lambda n: n.tag == "section",
    lambda n: n.tag == "div" and "paragraf" in n.attrs.get("class", ""),
    lambda n: n.tag == "div" and "section" in n.attrs.get("class", ""),
    lambda n: n.tag == "div" and "kapittel" in n.attrs.get("class", ""),
)
_MAIN, _DOC, _RATE = re.compile("content|main|article"), re.compile("doc|spec|content"), re.compile("rate|sats|mva")
_RATE_HREF, _CHAPTER = re.compile("satser|mva.*sats"), re.compile(r"(?:Kapittel|Kapitel)\s*(\d+)", re.I)
_FOLLOW = ("p", "ul", "ol", "div", "table", "pre")


def main_content(root: Node) -> Node:
    """The main element, else the first div that looks like content, else the page."""
    mains = root.find("main")
    found = mains or [n for n in root.find("div") if n.class_matches(_MAIN)]
    return found[0] if found else root


def _row(kind: str, node: Node | None = None, **more: object) -> dict:
    return {"kind": kind, "tag": node.tag if node else None, "node_id": node.attrs.get("id") if node else None, "ord": node.pre if node else 0} | more


def _sections(root: Node) -> Iterator[dict]:
    nodes = list(root.walk())
    found = next((hits for test in _SECTION_TESTS if (hits := [n for n in nodes if test(n)])), None) or root.find(*HEADINGS)
    chapters: dict[int, str | None] = {}  # of each ancestor once

    def chapter(node: Node) -> str | None:
        for above in node.ancestors():
            if above.pre not in chapters:
                hit = _CHAPTER.search(above.raw())
                chapters[above.pre] = hit[1] if hit else None
            if chapters[above.pre]:
                return chapters[above.pre]
        return None

    for node in found:
        headings = node.find(*HEADINGS)
        text = node.text()
        yield _row("section", node, heading=headings[0].text() if headings else text.split("\n")[0].strip()[:100], text=text, raw=node.raw(), chapter=chapter(node))


def _page(root: Node) -> dict:
    first = lambda test: next((n for n in root.walk() if test(n)), None)
    titles = [first(lambda n: n.tag == "h1" and "title" in n.classes), first(lambda n: n.tag == "h1"), *(first(lambda n, c=c: c in n.classes) for c in ("document-title", "law-title")), first(lambda n: n.tag == "title"), *(first(lambda n, c=c: c in n.classes) for c in ("main-title", "page-title"))]
    h1, title = titles[1], titles[4]
    chapter = first(lambda n: "chapter" in n.classes or "kapittel" in n.classes or n.tag == "h2")
    inside = lambda n, c: any(c in a.classes for a in n.ancestors())
    tests = (
        lambda n: n.tag == "h2" and "Kapittel" in n.raw(),
        lambda n: n.tag == "h3" and "Kapittel" in n.raw(),
        lambda n: n.tag == "h2" and inside(n, "chapter"),
        lambda n: n.tag == "h2" and inside(n, "kapittel"),
        lambda n: n.tag == "h2" and "chapter" in n.attrs.get("class", ""),
        lambda n: n.tag == "h2" and "kapittel" in n.attrs.get("class", ""),
    )
    head = first(lambda n: n.tag in ("title", "h1"))
    return _row(
        "page",
        heading=next((t for n in titles if n and (t := n.raw().strip())), ""),
        text=h1.raw().strip() if h1 else "",
        text_plain=title.raw().strip() if title else "",
        context=head.raw() if head else "",
        raw=root.raw(),
        chapter=chapter.raw().strip() if chapter else "",
        cells=[n.raw().strip() for test in tests if (n := first(test))],
    )


def _tables(main: Node) -> Iterator[dict]:
    for table in main.find("table"):
        rows = table.find("tr")
        headers = [c.text() for c in rows[0].find("th", "td")] if rows else []
        for i, row in enumerate(rows):
            yield _row("table_row", row, part=i, headers=headers, cells=[c.text() for c in row.find("td", "th")])


def _lists(main: Node) -> Iterator[dict]:
    for owner in main.find("ul", "ol"):
        parent = owner.above("div", "section", "article")
        context = parent.text() if parent else ""
        for i, item in enumerate(owner.find("li")):
            yield _row("list_item", item, part=i, text=item.text(), context=context) | {"ord": owner.pre}


def _headings(main: Node) -> Iterator[dict]:
    for heading in main.find(*HEADINGS):
        siblings = [c for c in heading.parent.children if isinstance(c, Node)] if heading.parent else []
        after = []
        for node in siblings[siblings.index(heading) + 1 :]:
            if node.tag in HEADINGS:
                break
            if node.tag in _FOLLOW:
                after.append(node)
        texts = [(n.tag, n.text()) for n in after]
        yield _row("heading", heading, heading=heading.text(), text=" ".join(t for _, t in texts), text_plain=" ".join(t for tag, t in texts if tag != "pre"))


def _context(node: Node, *tags: str) -> str | None:
    parent = node.above(*tags)
    return parent.text() if parent else None


def _blocks(html: str) -> Iterator[dict]:
    root = parse(html)
    main = main_content(root)
    yield _page(root)
    yield from _sections(root)
    yield from _tables(main)
    yield from _lists(main)
    yield from _headings(main)
    for node in main.walk():
        if node is main:
            continue
        if node.tag in ("pre", "code"):
            yield _row("code", node, text=node.text())
        if node.tag in ("div", "section") and node.class_matches(_DOC):
            yield _row("documentation", node, text=node.text())
        if node.tag in ("div", "section", "p") and node.class_matches(_RATE):
            yield _row("rate_block", node, text=node.text())
        if node.tag == "a" and "href" in node.attrs:
            text = node.text()
            yield _row("link", node, text=text, context=_context(node, "div", "section", "p"), attrs=[("href", node.attrs["href"])])
            if _RATE_HREF.search(node.attrs["href"]):
                yield _row("rate_link", node, text=text, context=_context(node, "div", "section", "p"))
    for form in main.find("form"):
        for node in form.find("input", "select", "textarea"):
            yield _row("form_field", node, context=form.text(), attrs=list(node.attrs.items()))
    label: Node | None = None
    for node in root.walk():
        if node.tag == "label":
            label = node
        elif node.tag in ("input", "select", "textarea") and any(a is main for a in node.ancestors()):
            yield _row("field", node, text=label.text() if label else None, attrs=list(node.attrs.items()))
    for i, (node, string) in enumerate(main.strings()):
        if string.strip():
            yield _row("string", node, part=i, raw=string, text=node.text())


def html_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """A row per block of a page, of the kinds that the parsers read; ``ord`` is its place in the page."""
    return _flat(pages, html, BLOCKS, _blocks)


def _flat(pages: DataFrame, html: str, ddl: str, rows: Callable[[str], Iterator[dict]]) -> DataFrame:
    """The other columns of a page with each row that ``rows`` makes of it; nulls count as empty pages."""
    kept = [c for c in pages.columns if c != html]
    fields = T.StructType.fromDDL(ddl)
    schema = T.StructType([*(pages.schema[c] for c in kept), *fields])
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                index, found = [], []
                for i, text in enumerate(part.column(width).to_pylist()):
                    try:
                        made = list(rows(text or ""))
                    except Exception as e:  # a page that can't be read is reported in its row
                        made = [{"error": f"{type(e).__name__}: {e}"}]
                    index += [i] * len(made)
                    found += made
                at = pa.array(index, pa.int32())
                columns = [part.column(k).take(at) for k in range(width)]
                columns += [pa.array([r.get(f.name) for r in found], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return pages.select(*kept, F.col(html).cast("string").alias("__html")).mapInArrow(run, schema)


# --- markup to markup ----------------------------------------------------------------

_ATTRIBUTES = ("href", "src", "alt", "title")


def _written(node: Node, dropped: tuple[str, ...], attributes: tuple[str, ...] | None = None) -> str:
    from html import escape

    out: list[str] = []
    stack: list[Node | str | tuple[str]] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            out.append(item[0])
        elif isinstance(item, str):
            out.append(escape(item, quote=False))
        elif item.tag not in dropped and not (item.tag == "a" and attributes is None and "del-paragraf" in item.attrs.get("href", "").lower()):
            attrs = "".join(f' {k}="{escape(v)}"' for k, v in item.attrs.items() if attributes is None or k in attributes)
            if item.tag != "[document]":
                out.append(f"<{item.tag}{attrs}/>" if item.tag in VOID else f"<{item.tag}{attrs}>")
                if item.tag not in VOID:
                    stack.append((f"</{item.tag}>",))
            stack += reversed(item.children)
    return "".join(out)


def display_html(html: str | None) -> str:
    """Markup without scripts, styles and page frames, with a few attributes only."""
    return _written(parse(html), ("script", "style", "nav", "footer", "header"), _ATTRIBUTES) if html else ""


def section_html(html: str | None, section_id: str | None) -> str:
    """The markup of a section, by its id or else of the part most like content, without page frames and share links."""
    if not html:
        return ""
    nodes = list(parse(html).walk())
    tests: list[Callable[[Node], bool]] = [lambda n: bool(section_id) and n.attrs.get("id") == section_id, lambda n: n.tag == "div" and "paragraf" in n.classes, lambda n: n.tag == "div" and "document-content" in n.classes, lambda n: n.tag == "main", lambda n: n.tag == "body"]
    found = next((n for test in tests for n in nodes if test(n)), None)
    return _written(found, ("nav", "header", "footer", "aside", "script", "style")) if found else ""


@F.pandas_udf(T.StringType())
def display_html_udf(html):  # noqa: ANN001, ANN201
    return html.map(display_html)


@F.pandas_udf(T.StringType())
def section_html_udf(html, section_id):  # noqa: ANN001, ANN201
    import pandas as pd

    return pd.Series([section_html(h, s) for h, s in zip(html, section_id, strict=True)])
