"""Structural joins over the nodes of pages.

A node spans the numbers from ``node_pre`` to ``node_post``, and what is below it lies within.
A node is joined with what is above, before or beside it by a merge of the sorted numbers in
window functions, page by page: no pairs are made, and all of these deal a page's nodes out
alike.  ``keys`` tell pages apart.

The nearest node of a kind above another one is found by levels: a running count says how many
nodes of the kind are open, and the last one that opened at just that level is the nearest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements whose texts aren't texts of the elements around them.
HIDDEN = ("script", "style", "template")
_ASKED, _OPENS, _CLOSES = 0, 1, 2


def nearest_above(nodes: DataFrame, keys: list[str], kind: Column, found: Column, name: str = "above") -> DataFrame:
    """Adds ``found`` of the nearest node above for which ``kind`` holds, or null.

    ``kind`` and ``found`` are columns of the node above; a node isn't above itself.
    """
    marked = nodes.withColumns({"__kind": F.coalesce(kind, F.lit(False)), "__found": F.struct(found.alias("v"))})
    event = lambda at, what, step: F.struct(F.col(at).alias("at"), F.lit(what).alias("what"), F.lit(step).alias("step"))
    asked = F.array(event("node_pre", _ASKED, 0))
    both = F.array(event("node_pre", _OPENS, 1), event("node_post", _CLOSES, -1))
    spread = marked.withColumn("__event", F.explode(F.when(F.col("__kind"), F.concat(asked, both)).otherwise(asked)))
    order = ("__event.at", "__event.what")
    level = F.sum("__event.step").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spread = spread.withColumn("__level", level).where(F.col("__event.what") != _CLOSES)
    opened = F.last(F.when(F.col("__event.what") == _OPENS, F.col("__found")), ignorenulls=True)
    last = opened.over(Window.partitionBy(*keys, "__level").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = spread.withColumn(name, F.when(F.col("__level") > 0, last["v"])).where(F.col("__event.what") == _ASKED)
    return out.drop("__kind", "__found", "__event", "__level")


def _last(nodes: DataFrame, by: list[str], kind: Column, found: Column, name: str) -> DataFrame:
    frame = Window.partitionBy(*by).orderBy("node_pre").rowsBetween(Window.unboundedPreceding, -1)
    held = F.when(F.coalesce(kind, F.lit(False)), F.struct(found.alias("v")))
    return nodes.withColumn(name, F.last(held, ignorenulls=True).over(frame)["v"])


def last_before(nodes: DataFrame, keys: list[str], kind: Column, found: Column, name: str = "before") -> DataFrame:
    """Adds ``found`` of the last node of a kind that began earlier in the page, or null: the label of a field."""
    return _last(nodes, keys, kind, found, name)


def leader(nodes: DataFrame, keys: list[str], kind: Column, found: Column, name: str = "leader") -> DataFrame:
    """Adds ``found`` of the last sibling of a kind before the node, or null: the heading that a block stands under."""
    return _last(nodes, [*keys, "parent_pre"], kind, found, name)


def full_texts(nodes: DataFrame, keys: list[str], name: str = "full_text") -> DataFrame:
    """The elements among ``nodes`` with all texts in them, stripped and joined by spaces.

    ``nodes`` have rows of texts too (``#text``).  The texts of a page are put together once;
    an element has the part between the texts before it and those before its end.  Texts of
    scripts and the like are left out.
    """
    hidden = nearest_above(nodes, keys, F.col("tag").isin(*HIDDEN), F.lit(True), "__hidden")
    own = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"^[\s ]+|[\s ]+$", ""))
    shown = (F.col("tag") == "#text") & F.col("__hidden").isNull() & (own != "")
    parts = hidden.withColumn("__part", F.when(shown, F.concat(own, F.lit(" "))))
    ends = F.when(F.col("tag") == "#text", F.array(F.struct(F.col("node_pre").alias("at"), F.lit(False).alias("end")))).otherwise(F.array(F.struct(F.col("node_pre").alias("at"), F.lit(False).alias("end")), F.struct(F.col("node_post").alias("at"), F.lit(True).alias("end"))))
    spread = parts.withColumn("__event", F.explode(ends))
    before = Window.partitionBy(*keys).orderBy("__event.at").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.sum(F.length("__part")).over(before), F.lit(0))
    placed = spread.withColumn("__size", size)
    page = placed.where("__part is not null").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("__event.at").alias("at"), F.col("__part").alias("part")))), lambda p: p["part"]), "").alias("__page"))
    rest = [c for c in nodes.columns if c not in (*keys, "node_pre")]
    elements = placed.where("tag != '#text'")
    spans = elements.groupBy(*keys, "node_pre").agg(F.min("__size").alias("__from"), F.max("__size").alias("__to"), *(F.first(c).alias(c) for c in rest))
    text = F.substring(F.col("__page"), F.col("__from") + 1, F.col("__to") - F.col("__from"))
    out = spans.join(page, keys, "left").withColumn(name, F.rtrim(F.coalesce(text, F.lit(""))))
    return out.select(*nodes.columns, name)
