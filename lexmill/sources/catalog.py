"""The source catalogue: what is fetched, from where and how it is routed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.sources.files import exists

COLUMNS = ("source_id", "title", "url", "version", "jurisdiction", "effective_from", "effective_to", "domain", "source_type", "publisher", "crawl_freq")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
DEFAULTS = {"version": "current", "jurisdiction": "NO", "domain": "unknown", "source_type": "unknown", "publisher": "unknown", "crawl_freq": "unknown"}


def load(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue, all strings; columns that the file lacks are null, a missing file has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    found = spark.read.option("header", True).option("comment", "#").csv(path)
    return found.select(*((F.col(c) if c in found.columns else F.lit(None)).cast("string").alias(c) for c in COLUMNS))


def invalidate(spark: SparkSession, path: str) -> None:
    """Forgets what the session holds of the catalogue's file, so that it's read anew."""
    spark.catalog.refreshByPath(path)


def with_defaults(sources: DataFrame) -> DataFrame:
    """Empty texts as null, then the defaults of a section's metadata."""
    return sources.withColumns({c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(DEFAULTS.get(c))) for c in sources.columns if c in COLUMNS})


def _same(column: str, value: str) -> Column:
    return F.lower(column) == value.lower()


def by_domain(sources: DataFrame, domain: str) -> DataFrame:
    return sources.where(_same("domain", domain))


def by_source_type(sources: DataFrame, *kinds: str) -> DataFrame:
    return sources.where(F.lower("source_type").isin(*(k.lower() for k in kinds)))


def by_publisher(sources: DataFrame, publisher: str) -> DataFrame:
    return sources.where(_same("publisher", publisher))


def by_crawl_frequency(sources: DataFrame, frequency: str) -> DataFrame:
    return sources.where(_same("crawl_freq", frequency))


def by_id_pattern(sources: DataFrame, part: str) -> DataFrame:
    """Sources whose id holds the text, in either case."""
    return sources.where(F.lower("source_id").contains(part.lower()))


def by_condition(sources: DataFrame, condition: Column) -> DataFrame:
    return sources.where(condition)


def by_id(sources: DataFrame, source_id: str) -> DataFrame:
    return sources.where(F.col("source_id") == source_id).limit(1)


def lookup(sources: DataFrame, key: str = "source_id", order: str = "ord") -> DataFrame:
    """One row per id that isn't blank, the last by ``order``."""
    rows = sources.where(F.coalesce(F.col(key), F.lit("")) != "")
    kept = [c for c in sources.columns if c != key]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*kept), order).alias("last"))
    return last.select(key, *(F.col(f"last.{c}").alias(c) for c in kept)).select(*sources.columns)


def route() -> Column:
    """The plan that a source's page goes to; null for none."""
    kind, name = F.lower("source_type"), F.lower("source_id")
    return (
        F.when(kind.isin("law", "forskrift"), "legal")
        .when(kind == "rates", "rates")
        .when(name.contains("amelding"), F.when(name.contains("overview"), "amelding_overview").when(name.contains("forms"), "amelding_forms").otherwise("amelding"))
        .when(name.contains("saft"), "saft")
    )
