"""Profiles: counts, shares, sizes, completeness, frequent words and searches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import filled, token_count


def counts(rows: DataFrame, *columns: str, unknown: str = "unknown") -> DataFrame:
    """(field, value, n) of each column on its own, in one pass by grouping sets."""
    named = rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias(c) for c in columns))
    sets = ", ".join(f"(`{c}`)" for c in columns)
    out = named.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")) if sets else named
    width = len(columns)
    field = F.coalesce(*(F.when(F.col("g") == ((1 << width) - 1) ^ (1 << (width - 1 - i)), F.lit(c)) for i, c in enumerate(columns)))
    return out.select(field.alias("field"), F.coalesce(*columns).alias("value"), "n")


def shares(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, percent) of a column's values."""
    own = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = own.agg(F.sum("n").alias("total"))
    return own.join(F.broadcast(total)).select("value", "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"))


def text_sizes(rows: DataFrame, text: str, *by: str) -> DataFrame:
    """Counts, and sums, means and extremes of characters and words."""
    chars, words = F.length(filled(text)), token_count(text)
    measures = [F.count(F.lit(1)).alias("n")]
    for name, c in (("chars", chars), ("tokens", words)):
        measures += [F.sum(c).cast("long").alias(f"{name}_sum"), F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{name}_avg"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max")]
    return rows.groupBy(*by).agg(*measures)


def completeness(rows: DataFrame, *columns: str) -> DataFrame:
    """(field, filled, total, percent): values that are null, empty, zero or false are missing."""
    one = rows.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(~missing(rows, c)).alias(c) for c in columns))
    parts = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns))
    out = one.select("total", F.explode(parts).alias("p")).select("p.field", "p.filled", "total")
    return out.withColumn("percent", F.when(F.col("total") > 0, F.col("filled") * 100.0 / F.col("total")).otherwise(0.0))


def missing(rows: DataFrame, column: str) -> Column:
    """Whether a value is null, or empty, zero or false of its type; so is a column that isn't there."""
    if column not in rows.columns:
        return F.lit(True)
    kind, c = rows.schema[column].dataType.typeName(), F.col(column)
    if kind in ("array", "map"):
        empty = F.size(c) == 0
    elif kind == "boolean":
        empty = ~c
    elif kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        empty = c == 0
    elif kind == "string":
        empty = c == ""
    else:
        empty = F.lit(False)
    return c.isNull() | F.coalesce(empty, F.lit(False))


def _word_lists(rows: DataFrame, text: str) -> Column:
    return F.filter(F.split(F.lower(filled(text)), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def _summary(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """The words that a task holds, with counts that fall short by no more than the row without a word says."""
    words, counts, short = pa.array([], pa.string()), np.zeros(0, np.int64), 0
    for batch in batches:
        found = pc.value_counts(pc.list_flatten(batch.column(0)))
        both = pa.table({"w": pa.concat_arrays([words, found.field("values")]), "n": np.concatenate([counts, found.field("counts").to_numpy()])}).group_by("w").aggregate([("n", "sum")])
        words, counts = both["w"].combine_chunks(), both["n_sum"].to_numpy()
        if len(counts) > 2 * held:  # what the next one has is taken off all
            least = int(np.partition(counts, -held - 1)[-held - 1])
            keep = np.flatnonzero(counts > least)
            words, counts, short = words.take(pa.array(keep)), counts[keep] - least, short + least
    words = pa.concat_arrays([words.cast(pa.string()), pa.nulls(1, pa.string())])
    yield pa.RecordBatch.from_arrays([words, pa.array(np.append(counts, short))], names=["word", "n"])


def frequent_words(rows: DataFrame, text: str, top: int = 20, longer_than: int = 3, held: int = 1 << 16) -> DataFrame:
    """(word, n) of the ``top`` words, of which only those of more characters are shown; ties go by the word.

    Each task sends a summary of at most twice ``held`` words, whose counts may fall short by a
    known number.  All words that can be among the first by these bounds are counted exactly in
    a second pass; the summaries are made anew with more words if the bounds don't tell.
    """
    lists = rows.select(_word_lists(rows, text).alias("words"))
    while True:
        sums = lists.mapInArrow(partial(_summary, held=held), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        first = sums.orderBy(F.col("word").isNotNull(), F.desc("n"), "word").limit(8 * top + 2).collect()
        short = sum(r["n"] for r in first if r["word"] is None)
        found = [(r["word"], r["n"]) for r in first if r["word"] is not None]
        least = found[top - 1][1] if len(found) >= top else 0
        # a word that isn't here has at most the last one's count, or none, and what that may fall short by
        rest = found[-1][1] if len(found) > 8 * top else 0
        if rest + short < least or not rest and not short:
            break
        if not short:  # counts are exact, and many words have the same
            return sums.where("word is not null").orderBy(F.desc("n"), "word").limit(top).where(F.length("word") > longer_than)
        held *= 8
    candidates = [w for w, n in found if n + short >= least]
    words = lists.select(F.explode("words").alias("word")).where(F.col("word").isin(candidates))
    best = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(top)
    return best.where(F.length("word") > longer_than)


def search(rows: DataFrame, query: str, field: str = "text") -> DataFrame:
    """Rows whose text field holds the query, in either case; fields of other types never do."""
    if rows.schema[field].dataType.typeName() != "string":
        return rows.where(F.lit(False))
    return rows.where(F.lower(F.col(field)).contains(query.lower()))


def search_context(rows: DataFrame, query: str, field: str = "text", reach: int = 40) -> DataFrame:
    """Adds ``at`` (from 1) and ``context`` around the first hit."""
    at = F.instr(F.lower(F.col(field)), query.lower())
    start = F.greatest(at - reach, F.lit(1))
    return search(rows, query, field).withColumns({"at": at, "context": F.substring(F.col(field), start, at - start + len(query) + reach)})


def head(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first rows by an order."""
    return rows.orderBy(*order).limit(n)
