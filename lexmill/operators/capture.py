"""Change capture: which contents are new, and the latest version of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import sha256_bytes

def fingerprints(contents: DataFrame, key: str = "source_id", content: str = "content") -> DataFrame:
    """(key, sha256, size_bytes) of binary contents."""
    return contents.select(key, sha256_bytes(content).alias("sha256"), F.octet_length(content).cast("long").alias("size_bytes"))


def changed(new: DataFrame, known: DataFrame, key: str = "source_id", digest: str = "sha256", size: str | None = None) -> DataFrame:
    """``new`` with ``changed``: whether its key is unknown, was known as empty, or has another digest.

    One left join on the key; ``known`` has a row per key at most.
    """
    old = known.select(F.col(key), F.col(digest).alias("__digest"), (F.col(size) if size else F.lit(1)).alias("__size"))
    both = new.join(old, key, "left")
    fresh = F.col("__digest").isNull() | (F.col("__size") == 0) | (F.col("__digest") != F.col(digest))
    return both.withColumn("changed", fresh).drop("__digest", "__size")


def latest(rows: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key, aggregated before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__row"))
    return best.select(*keys, *(F.col(f"__row.{c}").alias(c) for c in rest)).select(*rows.columns)


def capture(fetched: DataFrame, known: DataFrame, bronze: str, run_id: str, extension: str = "html") -> DataFrame:
    """The manifest's new rows for (source_id, url, content, error), with the content.

    ``known`` has the last version of each source.  Failed fetches are rows with an error;
    ``changed`` is true where the content is to be written.
    """
    good = fetched.where("error is null").withColumns({"sha256": sha256_bytes("content"), "size_bytes": F.octet_length("content").cast("long")})
    marked = changed(good, known, size="size_bytes")
    rows = marked.unionByName(fetched.where("error is not null"), allowMissingColumns=True)
    return rows.select(
        "source_id",
        "url",
        F.when(F.col("error").isNull(), F.concat(F.lit(f"{bronze}/"), F.col("source_id"), F.lit(f".{extension}"))).alias("file_path"),
        F.col("error").isNull().alias("success"),
        "sha256",
        F.coalesce("changed", F.lit(False)).alias("changed"),
        F.lit(False).alias("stale"),
        "size_bytes",
        "error",
        F.lit(run_id).alias("run_id"),
        F.lit(None).cast("timestamp").alias("modified_at"),
        F.current_timestamp().alias("captured_at"),
        "content",
    )


def counters(rows: DataFrame, done: str, total: str = "1") -> DataFrame:
    """(total, processed, failed, success_rate) of rows; each failure counts once."""
    out = rows.agg(F.sum(F.expr(total)).cast("long").alias("total"), F.sum(F.expr(f"cast({done} as long)")).cast("long").alias("processed"))
    out = out.select(F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("processed", F.lit(0)).cast("long").alias("processed"))
    rate = F.when(F.col("total") > 0, F.col("processed") / F.col("total") * 100).otherwise(0.0)
    return out.select("total", "processed", (F.col("total") - F.col("processed")).alias("failed"), rate.alias("success_rate"))
