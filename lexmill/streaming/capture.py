"""Bronze change capture of a stream of contents, with each source's last version as keyed state.

A row is new if its (time, digest) comes after those of the last version of its source and its
digest is another one, so what arrives late, again, or in another order gives the same last
version.  The state of a new stream begins with what the manifest knows.  A batch is written
once, as a folder of contents named by stream and batch, from which its commit in the
manifest is made; a batch that is repeated after a failure replaces the folder if the commit
is missing, and does nothing if it is there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lexmill.functions.text import sha256_bytes
from lexmill.operators.manifest import COMMITS, Manifest, safe
from lexmill.settings import Settings

#: ``at`` is the time of modification in microseconds.
_STATE = "sha256 string, size_bytes long, at long"
_JUDGED = "source_id string, url string, content binary, error string, at long, sha256 string, size_bytes long, changed boolean, stale boolean"
_COLUMNS = [c.split()[0] for c in _JUDGED.split(", ")]
_ROW = Row(*_COLUMNS)
_STORE = "spark.sql.streaming.stateStore.providerClass"


def arriving_files(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """(source_id, url, content, error, modified_at) of files as they arrive; a source's id is the file's name."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", pattern).load(folder)
    name = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return files.select(name.alias("source_id"), F.col("path").alias("url"), "content", F.lit(None).cast("string").alias("error"), F.col("modificationTime").alias("modified_at"))


class Versions(StatefulProcessor):
    """Judges the contents of one source against its last version."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", _STATE)

    def handleInitialState(self, key: Any, initialState: Any, timerValues: Any) -> None:  # noqa: N802, N803
        row = initialState[0] if isinstance(initialState, list) else initialState
        self._last.update((row["sha256"], row["size_bytes"], row["at"]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        last, before = self._last.get(), None
        for row in sorted(rows, key=lambda r: (r["at"] or 0, r["sha256"] or "")):
            changed = stale = False
            if row["sha256"] is not None:  # a failure says nothing of the content
                stale = last is not None and (row["at"] or 0, row["sha256"]) < (last[2], last[0])
                changed = not stale and (last is None or last[0] != row["sha256"] or not last[1])
                if not stale:
                    last = before = (row["sha256"], row["size_bytes"], row["at"] or 0)
            yield _ROW(*(row["content"] if c == "content" and changed else None if c == "content" else changed if c == "changed" else stale if c == "stale" else row[c] for c in _COLUMNS))
        if before is not None:
            self._last.update(before)

    def close(self) -> None:
        pass


def judged(contents: DataFrame, known: DataFrame) -> DataFrame:
    """The stream's rows with digest, ``changed`` and ``stale`` (older than the last version); contents only where they changed."""
    good = F.col("error").isNull()
    rows = contents.withColumns({"sha256": F.when(good, sha256_bytes("content")), "size_bytes": F.when(good, F.octet_length("content").cast("long")), "at": F.unix_micros("modified_at")})
    before = known.select("source_id", "sha256", "size_bytes", F.unix_micros(F.coalesce("modified_at", "captured_at")).alias("at")).groupBy("source_id")
    out = rows.drop("modified_at").groupBy("source_id").transformWithState(Versions(), _JUDGED, "append", "none", before)
    return out.withColumn("modified_at", F.timestamp_micros("at")).drop("at")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def write_batch(batch: DataFrame, run: str, settings: Settings, extension: str = "html", commits: int = COMMITS) -> None:
    """Writes a batch's contents, then its commit; does nothing where the commit is there."""
    spark, manifest = batch.sparkSession, Manifest(batch.sparkSession, f"{settings.bronze}/manifest")
    if manifest.has(run):
        return
    path = f"{settings.bronze}/contents/{safe(run)}"
    batch.withColumns({"run_id": F.lit(run), "captured_at": F.current_timestamp()}).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).drop("content")
    there = F.concat(F.lit(f"{settings.bronze}/"), F.col("source_id"), F.lit(f".{extension}"))
    manifest.commit(rows.withColumns({"file_path": F.when(F.col("error").isNull(), there), "success": F.col("error").isNull()}), run)
    manifest.compact(commits)


def capture_stream(contents: DataFrame, settings: Settings, checkpoint: str, extension: str = "html", commits: int = COMMITS) -> StreamingQuery:
    """Captures (source_id, url, content, error, modified_at) until nothing more has arrived.

    Contents that are new or changed go to the bronze contents, every outcome to the manifest.
    """
    spark = contents.sparkSession
    # what keeps values by key beyond a batch
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    known = Manifest(spark, f"{settings.bronze}/manifest").last()

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, f"stream-{stream_id(batch.sparkSession, checkpoint)}-{number}", settings, extension, commits)

    return judged(contents, known).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
