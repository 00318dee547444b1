"""Nodes of the audit file specification, from the blocks of a page or from a document's text and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import extract as X
from lexmill.functions.text import any_of, filled, first_match
from lexmill.plans.rates import _BLOCK_COLUMNS

IDENTIFIER = "([a-zA-Z_][a-zA-Z0-9_.]*)"
MIN_CONTENT, MIN_ITEM = 20, 10
# Key words of headings that navigate, and of what belongs to the specification.
NAVIGATION = ("navigasjon", "meny", "innhold", "overskrift", "cookie")
TOPIC = ("saft", "node", "element", "field", "specification")


def _nodes(rows: DataFrame, kept: list[str], version: str, part: int, path: Column, description: Column, source: Column, data_type: Column, form: Column, cardinality: Column | None = None) -> DataFrame:
    """Nodes whose five lists are read from ``source``; rows without a path are dropped."""
    named = rows.select(*kept, "ord", path.alias("raw_path"), description.alias("description"), source.alias("source"), data_type.alias("data_type"), form.alias("format"), (cardinality if cardinality is not None else F.lit("1")).alias("cardinality"))
    return named.where(filled("raw_path") != "").select(
        *kept,
        F.lit(part).alias("part"),
        "ord",
        F.lit("SAF-T").alias("spec"),
        F.lit(version).alias("version"),
        X.node_path("raw_path").alias("node_path"),
        "cardinality",
        "description",
        "data_type",
        "format",
        X.validation_rules("source").alias("validation_rules"),
        X.business_rules("source").alias("business_rules"),
        X.examples("source").alias("examples"),
        X.dependencies("source").alias("dependencies"),
        X.technical_details("source").alias("technical_details"),
        X.path_priority("raw_path").alias("priority"),
        X.text_complexity("source").alias("complexity"),
        F.lit("Skatteetaten").alias("publisher"),
        F.lit(True).alias("is_current"),
    )


def row_entries(headers: str = "headers", cells: str = "cells") -> Column:
    """(k, v) of a table row: cells with the header at their place; of equal headers the last cell counts."""
    pairs = F.arrays_zip(F.slice(headers, 1, F.size(cells)).alias("k"), F.slice(cells, 1, F.size(headers)).alias("v"))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"].alias("v")))


def row_text(entries: Column) -> Column:
    """A row's headers and cells as one text, for key words."""
    return F.array_join(F.flatten(F.transform(entries, lambda p: F.array(p["k"], p["v"]))), " ")


def _of_kind(entries: Column, *words: str, but: tuple[str, ...] = ()) -> Column:
    return F.filter(entries, lambda p: any_of(p["k"], *words) & (~any_of(p["k"], *but) if but else F.lit(True)))


def page_nodes(blocks: DataFrame, version: str = "1.30") -> DataFrame:
    """Nodes of tables, lists, headings, code and documentation."""
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    text, none = F.col("text"), F.lit("")
    rows = blocks.where("kind = 'table_row' and part > 0 and size(cells) >= 2").withColumn("entries", row_entries())
    rows = rows.where(any_of(row_text(F.col("entries")), "saft", "node", "element", "field"))
    desc, card = ("description", "beskrivelse", "desc"), ("cardinality", "kardinalitet", "occurs")
    last = lambda found: F.when(F.size(found) > 0, F.element_at(found, -1)["v"]).otherwise(none)
    path = F.get(_of_kind(F.col("entries"), "path", "node", "element", "field"), F.lit(0))["v"]
    described = last(_of_kind(F.col("entries"), *desc))
    typed = last(_of_kind(F.col("entries"), "type", "datatype", "format", but=(*desc, *card)))
    typed = F.when(typed == "", F.lit("string")).otherwise(typed)
    said = F.when(described == "", F.concat(F.lit("SAF-T node: "), path)).otherwise(described)
    tables = _nodes(rows, kept, version, 0, path, said, described, typed, X.type_format(typed), X.cardinality(last(_of_kind(F.col("entries"), *card, but=desc))))
    own = F.regexp_extract(text, IDENTIFIER, 1)
    items = blocks.where("kind = 'list_item'").where((F.length("text") > MIN_ITEM) & any_of("context", *TOPIC))
    items = _nodes(items, kept, version, 1, own, text, text, X.data_type(text), X.text_format(text))
    code = blocks.where("kind = 'code'").where(any_of("text", "<", "xml", "saft", "node", "element"))
    element = F.regexp_extract(text, "<" + IDENTIFIER, 1)
    code = _nodes(code, kept, version, 3, element, F.concat(F.lit("XML element: "), element), text, F.lit("string"), F.lit("XML"))
    docs = blocks.where("kind = 'documentation'").where(any_of("text", *TOPIC))
    docs = _nodes(docs, kept, version, 4, own, text, text, X.data_type(text), X.text_format(text))
    return tables.unionByName(items).unionByName(documentation_nodes(blocks, version)).unionByName(code).unionByName(docs)


def documentation_nodes(blocks: DataFrame, version: str = "1.30") -> DataFrame:
    """Nodes of headings and what follows them; the path is the first identifier of the heading."""
    kept = [c for c in blocks.columns if c not in _BLOCK_COLUMNS]
    rows = blocks.where("kind = 'heading'").where((F.length("text") > MIN_CONTENT) & ~any_of("heading", *NAVIGATION))
    text = F.col("text")
    return _nodes(rows, kept, version, 2, F.regexp_extract("heading", IDENTIFIER, 1), F.concat("heading", F.lit(": "), text), text, X.data_type(text), X.text_format(text))


def silver(nodes: DataFrame) -> DataFrame:
    """Nodes with the fields that the declared schema asks for."""
    parts = F.split("node_path", r"\.")
    return nodes.withColumns(
        {
            "node_id": F.concat_ws("_", F.lit("saft"), F.col("node_path")),
            "node_label": F.element_at(parts, -1),
            "node_level": F.size(parts),
            "parent_id": F.when(F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), ".")),
            "domain": F.lit("tax"),
            "source_type": F.lit("specification"),
            "jurisdiction": F.lit("NO"),
            "last_updated": F.current_timestamp().cast("string"),
        }
    )


# --- documents -----------------------------------------------------------------------

# How nodes stand in a document's text: path, cardinality or attributes, description.
_ELEMENT = r"(?Usm)(\w+(?:\.\w+)*)\s*\(([0-9*.,]+)\)\s*:\s*(.+?)(?=\n\w|\n\n|$)"
_MARKUP = r"(?Usm)<(\w+(?:\.\w+)*)\s*([^>]*)>\s*(.*?)(?=<|$)"
_PIPES = r"(?Udm)(\w+(?:\.\w+)*)\s*\|\s*([0-9*.,]+)\s*\|\s*(.+?)(?=\n\w|\n\n|$)"


def _found(text: Column, pattern: str, part: int) -> Column:
    groups = [F.regexp_extract_all(text, F.lit(pattern), F.lit(i)) for i in (1, 2, 3)]
    zipped = F.arrays_zip(*(g.alias(n) for g, n in zip(groups, "abc", strict=True)))
    return F.transform(zipped, lambda m, i: F.struct(F.lit(part).alias("part"), i.alias("i"), m["a"].alias("__path"), m["b"].alias("__said"), m["c"].alias("__text")))


def _occurs(attributes: Column) -> Column:
    least, most = F.regexp_extract(attributes, 'minOccurs="([^"]*)"', 1), F.regexp_extract(attributes, 'maxOccurs="([^"]*)"', 1)
    both = attributes.rlike('minOccurs="[^"]*"') & attributes.rlike('maxOccurs="[^"]*"')
    return F.when(both, F.concat(least, F.lit(".."), F.when(most == "unbounded", F.lit("*")).otherwise(most))).otherwise("1..1")


def _document_nodes(rows: DataFrame, kept: list[str], version: str) -> DataFrame:
    """(part, i, __path, __said, __text, __typed) as nodes; paths of one character are dropped."""
    path = F.trim("__path")
    text = F.trim(filled("__text"))
    rows = rows.where(F.length(path) >= 2).withColumns({"__path": path, "description": F.when(text == "", F.concat(F.lit("SAF-T element: "), path)).otherwise(text)})
    typed = F.when(filled("__typed") == "", X.document_data_type("description")).otherwise(F.col("__typed"))
    return rows.select(
        *kept,
        "part",
        F.col("i").alias("ord"),
        F.lit("SAF-T").alias("spec"),
        F.lit(version).alias("version"),
        F.col("__path").alias("node_path"),
        X.document_cardinality("__said").alias("cardinality"),
        "description",
        typed.alias("data_type"),
        X.document_type_format(typed).alias("format"),
        X.document_rules("description").alias("validation_rules"),
        X.document_examples("description").alias("examples"),
        X.document_details("description").alias("technical_details"),
        F.lit("Skatteetaten").alias("publisher"),
        F.lit(True).alias("is_current"),
    )


def text_nodes(docs: DataFrame, text: str = "text", prefix: Column | None = None, version: str = "1.30") -> DataFrame:
    """Nodes of a document's text, with a prefix to their paths."""
    kept = [c for c in docs.columns if c not in (text, "tables")]
    before = prefix if prefix is not None else F.lit("")
    own = filled(text)
    rows = docs.select(*kept, before.alias("__prefix"), F.explode(F.concat(_found(own, _ELEMENT, 0), _found(own, _MARKUP, 1), _found(own, _PIPES, 2))).alias("m")).select(*kept, "__prefix", "m.*")
    path = F.when((F.col("__prefix") != "") & ~F.col("__path").startswith(F.col("__prefix")), F.concat("__prefix", F.lit("."), "__path")).otherwise(F.col("__path"))
    said = F.when(F.col("part") == 1, _occurs(F.col("__said"))).otherwise(F.trim("__said"))
    return _document_nodes(rows.withColumns({"__path": path, "__said": said, "__typed": F.lit("")}), kept, version)


# Key words of table headers, tried in this order; the last column of a kind counts.
_COLUMNS = (("path", ("xml element", "element", "name")), ("needed", ("req", "required", "mandatory", "optional")), ("said", ("rep", "repetition", "cardinality", "occurs")), ("text", ("description", "desc", "comment")), ("typed", ("type", "datatype", "format")))


def table_nodes(docs: DataFrame, tables: str = "tables", version: str = "1.30") -> DataFrame:
    """Nodes of a document's tables, whose columns are told by their headers."""
    kept = [c for c in docs.columns if c not in (tables, "text")]
    rows = docs.select(*kept, F.posexplode(tables).alias("part", "t")).where(F.size("t") >= 2)
    kinds = F.transform(F.get("t", F.lit(0)), lambda h: first_match([(any_of(F.trim(filled(h)), *words), name) for name, words in _COLUMNS], ""))
    rows = rows.withColumn("kinds", kinds).select(*kept, "part", "kinds", F.posexplode(F.slice("t", 2, 2_000_000_000)).alias("i", "cells")).where(F.size("cells") >= 2)

    def cell(name: str) -> Column:
        at = F.array_max(F.transform("kinds", lambda k, i: F.when(k == name, i)))
        return F.trim(filled(F.get("cells", at)))

    rows = rows.select(*kept, "part", "i", cell("path").alias("__path"), X.table_cardinality(cell("said")).alias("__said"), cell("text").alias("__text"), cell("typed").alias("__typed"))
    return _document_nodes(rows.where(~F.lower("__path").isin("element", "structure") & ~F.col("__path").startswith("<")), kept, version)


def document_nodes(docs: DataFrame, key: str, name: str, prefixes: dict[str, str], version: str = "1.30") -> DataFrame:
    """Nodes of documents: of those without a prefix by their tables, or their text if these have none; of others by their text."""
    prefix = first_match([(F.col(name) == n, p) for n, p in prefixes.items()], "")
    plain = docs.where(prefix == "")
    tables = table_nodes(plain, version=version)
    other = plain.join(tables.select(key).distinct(), key, "left_anti").unionByName(docs.where(prefix != ""))
    return tables.unionByName(text_nodes(other, prefix=prefix, version=version))
