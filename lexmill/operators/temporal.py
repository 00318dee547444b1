"""Joins with what holds on a day: dated versions by key.

A version's interval is put under a few aligned blocks of days: of the first width of
``WIDTHS`` by which it covers at most ``SPREAD`` blocks, so a long interval takes few, wide
blocks.  A day lies in one block of each width, so rows are joined by (key, width, block), an
equal join that Spark deals out, and the days decide among the versions of a block.  Only the
widths that the versions have are tried.

Where one value a day is wanted of all that hold, no pairs of rows and versions are made: an
interval is cut into the aligned blocks that make it up exactly (``pieces``), the versions of a
block are summed up into one row, and a day takes the rows of the blocks that it lies in, one
of each level.  This is done once for each key and day, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a block; an open end is far away, and takes the last width.
WIDTHS = (16, 256, 4096, 65536, 1 << 20)
SPREAD = 16
#: A block of a level has 1 << BITS of the level below, those of the first level a day; all days that there are lie in one or two blocks of the last.
BITS, LEVELS = 3, 12
_FIRST, _LAST = "0001-01-01", "9999-12-31"


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def _from_to(versions: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """Versions with ``__from`` and ``__to`` as days, without those that end before they begin."""
    first = _day(F.coalesce(F.col(valid_from).cast("date"), F.lit(_FIRST).cast("date")))
    last = _day(F.coalesce(F.col(valid_to).cast("date"), F.lit(_LAST).cast("date")))
    return versions.withColumns({"__from": first, "__to": last}).where("__from <= __to")


def blocks(versions: DataFrame, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions with ``__from`` and ``__to`` as days, a row for each block (``__width``, ``__block``); those that end before they begin have none."""
    dated = _from_to(versions, valid_from, valid_to)
    fits = [F.when(F.floor(F.col("__to") / w) - F.floor(F.col("__from") / w) < SPREAD, F.lit(w)) for w in WIDTHS[:-1]]
    dated = dated.withColumn("__width", F.coalesce(*fits, F.lit(WIDTHS[-1])))
    covered = F.sequence(F.floor(F.col("__from") / F.col("__width")), F.floor(F.col("__to") / F.col("__width")))
    return dated.withColumn("__block", F.explode(covered))


def pieces(versions: DataFrame, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Versions, a row for each block (``__level``, ``__block``) of those that make up its days: every day lies in one, and no other day does."""

    def inner(level: int) -> tuple[Column, Column]:
        """The blocks of a level that lie within the interval: the first, and the first one behind them."""
        shift = BITS * level
        return F.shiftright(F.col("__from").cast("long") + ((1 << shift) - 1), shift), F.shiftright(F.col("__to").cast("long") + 1, shift)

    def between(a: Column, b: Column, level: int) -> Column:
        own = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(own, lambda k: F.struct(F.lit(level).alias("__level"), k.alias("__block")))

    cut = []
    for level in range(LEVELS):
        (a, b), (above, behind) = inner(level), (F.shiftleft(c, BITS) for c in inner(level + 1))
        # without those that lie in a block of the level above
        cut += [between(a, F.when(above < behind, above).otherwise(b), level), between(F.when(above < behind, behind).otherwise(b), b, level)]
    return _from_to(versions, valid_from, valid_to).withColumn("__piece", F.explode(F.concat(*cut))).select(*versions.columns, "__piece.*")


def _at_days(rows: DataFrame, cut: DataFrame, on: list[str], day: str, *merged: Column) -> DataFrame:
    """(on, __day, merged) of each key and day that the rows have, from what the blocks of ``cut`` hold."""
    levels = sorted(r[0] for r in cut.select("__level").distinct().collect())  # at most LEVELS
    tried = F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))
    days = rows.select(*on, _day(F.col(day)).alias("__day")).distinct().withColumn("__level", tried)
    placed = days.withColumn("__block", F.expr(f"shiftright(cast(__day as bigint), {BITS} * __level)"))
    return placed.join(cut, [*on, "__level", "__block"]).groupBy(*on, "__day").agg(*merged)


def holding(rows: DataFrame, versions: DataFrame, on: list[str], day: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Each row with every version of its key that holds on its day, both ends included; rows without one are left out.

    A null start or end is open, a row without a day or key has no version.
    """
    cut = blocks(versions, valid_from, valid_to)
    widths = sorted(r[0] for r in cut.select("__width").distinct().collect())  # at most len(WIDTHS)
    own = _day(F.col(day))
    tried = F.explode(F.array(*map(F.lit, widths)) if widths else F.array().cast("array<int>"))
    placed = rows.withColumn("__day", own).withColumn("__width", tried).withColumn("__block", F.floor(F.col("__day") / F.col("__width")))
    joined = placed.join(cut, [*on, "__width", "__block"]).where("__day between __from and __to")
    return joined.drop("__day", "__width", "__block", "__from", "__to")


def holding_sums(rows: DataFrame, versions: DataFrame, on: list[str], day: str, value: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Each row with ``n``, how many versions of its key hold on its day, and ``total``, the sum of their ``value``; rows without one are left out.

    As ``holding`` and sums by row, without its pairs.
    """
    cut = pieces(versions, valid_from, valid_to).groupBy(*on, "__level", "__block").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    found = _at_days(rows, cut, on, day, F.sum("n").alias("n"), F.sum("total").alias("total"))
    return rows.withColumn("__day", _day(F.col(day))).join(found, [*on, "__day"]).select(*rows.columns, "n", "total")


def in_force(rows: DataFrame, versions: DataFrame, on: list[str], day: str, row_id: str, valid_from: str = "valid_from", valid_to: str = "valid_to", tie: str | None = None) -> DataFrame:
    """Each row with the version in force on its day: of several that hold, the one that began last, then the greatest ``tie``; else nulls.

    ``row_id`` tells rows apart; rows that share one have the version that began last for any of them, those without one have none.
    A block keeps its best version, and a key and day the best of its blocks, before rows take part.
    """
    said = [c for c in versions.columns if c not in on]
    order = F.struct(F.coalesce(F.col(valid_from).cast("date"), F.lit(_FIRST).cast("date")), *([F.col(tie)] if tie else []))
    best = lambda version, by: (F.max(by).alias("__order"), F.max_by(version, by).alias("__version"))
    cut = pieces(versions, valid_from, valid_to).groupBy(*on, "__level", "__block").agg(*best(F.struct(*said), order))
    found = _at_days(rows, cut, on, day, *best(F.col("__version"), F.col("__order")))
    placed = rows.withColumn("__day", _day(F.col(day))).join(found, [*on, "__day"], "left")
    own = F.when(F.col(row_id).isNotNull(), F.max_by("__version", "__order").over(Window.partitionBy(row_id)))
    return placed.select(*rows.columns, own.alias("__own")).select(*rows.columns, *(F.col(f"__own.{c}").alias(c) for c in said))
