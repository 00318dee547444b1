"""Windows over events, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _late(events: DataFrame, ts: str, delay: str | None) -> DataFrame:
    return events.withWatermark(ts, delay) if delay else events


def _measures(value: str) -> list:
    return [F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total")]


def tumbling(events: DataFrame, ts: str = "ts", width: str = "1 hour", by: str = "event_type", value: str = "value", delay: str | None = None) -> DataFrame:
    """(window_start, by, n, total); ``delay`` is the watermark of a stream."""
    out = _late(events, ts, delay).groupBy(F.window(ts, width).alias("w"), by).agg(*_measures(value))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sliding(events: DataFrame, ts: str = "ts", width: str = "2 hours", step: str = "1 hour", by: str = "event_type", value: str = "value", delay: str | None = None) -> DataFrame:
    out = _late(events, ts, delay).groupBy(F.window(ts, width, step).alias("w"), by).agg(*_measures(value))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", gap: str = "30 minutes", by: str = "user_id", value: str = "value", delay: str | None = None) -> DataFrame:
    """(by, session_start, session_end, n, total); a session ends ``gap`` after its last event."""
    out = _late(events, ts, delay).groupBy(F.session_window(ts, gap).alias("w"), by).agg(*_measures(value))
    return out.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total")


def deduplicated(events: DataFrame, *keys: str, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """Events without repeats of their keys."""
    return _late(events, ts, delay).dropDuplicatesWithinWatermark(list(keys)) if delay else events.dropDuplicates(list(keys))


def last_before(events: DataFrame, condition: str, column: str, by: str = "user_id", ts: str = "ts", tie: str = "event_id", block: str = "1 day") -> DataFrame:
    """Adds ``last_seen``: the column's value at the latest earlier event of the same key that meets the condition.

    A key's history is cut into blocks of time, of which each is one task's at most; what the
    blocks before say is carried on by a window over one row a block.
    """
    cut = events.withColumn("__block", F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {block})")))
    value = F.expr(f"case when {condition} then {column} end")
    last = F.max_by(value, F.when(value.isNotNull(), F.struct(ts, tie))).alias("__said")
    blocks = cut.groupBy(F.col(by).alias("__key"), F.col("__block").alias("__at")).agg(last)
    carried = blocks.withColumn("__carried", F.expr("last(__said, true) over (partition by __key order by __at rows between unbounded preceding and 1 preceding)")).drop("__said")
    inner = F.expr(f"last(case when {condition} then {column} end, true) over (partition by {by}, __block order by {ts}, {tie} rows between unbounded preceding and 1 preceding)")
    out = cut.withColumn("__inner", inner).join(carried, F.col(by).eqNullSafe(F.col("__key")) & F.col("__block").eqNullSafe(F.col("__at")), "left")
    return out.select(*events.columns, F.coalesce("__inner", "__carried").alias("last_seen"))
