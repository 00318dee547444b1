"""Leakage-free splits: all rows of a family go to the same side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def family_order(family: Column, seed: int) -> Column:
    """The place of a family in a shuffle that only depends on the seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), family).cast("binary"))


def family_split(rows: DataFrame, family: str, ratio: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds ``split``: train for the first ``floor(families * ratio)`` families of the shuffle, else val.

    Rows are never gathered: families are made distinct by a two-phase aggregation, and
    their ranks, in parallel by the first digits of the hash, are offsets plus local ranks.
    A null family is a family of its own.
    """
    name = F.coalesce(F.col(family).cast("string"), F.lit("unknown"))
    keyed = rows.withColumn("__family", name)
    families = keyed.select("__family").distinct().withColumn("__h", family_order(F.col("__family"), seed))
    families = families.withColumn("__bin", F.substring("__h", 1, 3))
    bins = families.groupBy("__bin").agg(F.count(F.lit(1)).alias("__n"))  # at most 4,096 rows
    before = F.expr("coalesce(sum(__n) over (order by __bin rows between unbounded preceding and 1 preceding), 0)")
    offsets = bins.withColumns({"__before": before, "__all": F.expr("sum(__n) over ()")})
    rank = F.expr("row_number() over (partition by __bin order by __h, __family)")
    ranked = families.withColumn("__rank", rank).join(F.broadcast(offsets.drop("__n")), "__bin")
    side = F.when(F.col("__rank") + F.col("__before") <= F.floor(F.col("__all").cast("double") * ratio), "train").otherwise("val")
    return keyed.join(ranked.select("__family", side.alias("split")), "__family").drop("__family")


def leaks(rows: DataFrame, family: str, split: str = "split") -> DataFrame:
    """The families that stand on both sides; none after ``family_split``."""
    return rows.groupBy(family).agg(F.count_distinct(split).alias("sides")).where("sides > 1")


def split_stats(rows: DataFrame, family: str, split: str = "split") -> DataFrame:
    return rows.groupBy(split).agg(F.count(F.lit(1)).alias("samples"), F.count_distinct(F.coalesce(F.col(family).cast("string"), F.lit("unknown"))).alias("families"))


def pick(values: list[str], *keys: Column, seed: int = 42) -> Column:
    """One of the values, by a hash of the keys: the same wherever and whenever it is computed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in keys)).cast("binary"))
    index = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % len(values)
    return F.get(F.array(*map(F.lit, values)), index)
