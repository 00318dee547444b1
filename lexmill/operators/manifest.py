"""The manifest of bronze contents: a log of commits, compacted into snapshots.

A commit is a folder of rows named by its run, which is there once it is whole; committing a
run again replaces or repeats nothing.  A snapshot has the last good version of each source,
sorted by source, and holds for all commits before it; these are then moved from ``log`` to
``history``.  So what is known of the sources is the newest snapshot and the few commits after
it, and the cost of a run doesn't grow with the number of runs before.

Versions are ordered by (time, digest), whatever the order in which they were committed, so
to merge a commit twice changes nothing.  Readers list the log before they pick a snapshot: a
commit that is compacted meanwhile is then read twice rather than missed (or its files are
gone, and the reader has to start anew).  Snapshots are numbered, and a number is claimed by
creating a file that mustn't be there, so one of two compactors at a time goes on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources import files

ROWS = "source_id string, url string, file_path string, success boolean, sha256 string, changed boolean, stale boolean, size_bytes long, error string, run_id string, modified_at timestamp, captured_at timestamp"
#: ``run_id`` is the run that saw the version last, ``content_run`` the one that wrote its content.
LAST = "source_id string, sha256 string, size_bytes long, modified_at timestamp, captured_at timestamp, run_id string, content_run string"
#: Commits after the newest snapshot from which on they are compacted.
COMMITS = 16


def safe(run: str) -> str:
    """The name of a run's folders."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", run)


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def latest_versions(rows: DataFrame) -> DataFrame:
    """Each source's version of the greatest time, then digest; aggregated before the shuffle."""
    rest = _names(LAST)[1:-1]
    order = F.struct(F.coalesce("modified_at", "captured_at"), F.col("sha256"))
    written = F.max_by("content_run", F.when(F.col("content_run").isNotNull(), order))
    best = rows.groupBy("source_id").agg(F.max_by(F.struct(*rest), order).alias("r"), written.alias("content_run"))
    return best.select("source_id", *(F.col(f"r.{c}").alias(c) for c in rest), "content_run")


class Manifest:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _whole(self, kind: str) -> list[str]:
        """The folders of a kind whose rows are all written."""
        return [f for f in files.listed(self.spark, f"{self.path}/{kind}") if files.exists(self.spark, f"{f}/_SUCCESS")]

    def commits(self) -> list[str]:
        """The names of the runs that no snapshot has yet."""
        return sorted(f.rsplit("/", 1)[-1] for f in self._whole("log"))

    def snapshots(self) -> list[str]:
        return sorted(self._whole("snapshots"))

    def history(self) -> DataFrame:
        """All rows of all runs."""
        return self._read(self._whole("log") + self._whole("history"), ROWS)

    def last(self) -> DataFrame:
        """The last good version of each source: what the newest snapshot and the commits after it say."""
        tail, snapshots = self._whole("log"), self.snapshots()
        rows = self._read(tail, ROWS).where("success").withColumn("content_run", F.when(F.col("changed"), F.col("run_id"))).select(*_names(LAST))
        return latest_versions(self._read(snapshots[-1:], LAST).unionByName(rows))

    def has(self, run: str) -> bool:
        return any(files.exists(self.spark, f"{self.path}/{kind}/{safe(run)}/_SUCCESS") for kind in ("log", "history"))

    def commit(self, rows: DataFrame, run: str) -> None:
        """Writes the rows of a run; one that was cut off is written anew, a whole one stays as it is."""
        if not self.has(run):
            rows.select(*_names(ROWS)).write.mode("overwrite").parquet(f"{self.path}/log/{safe(run)}")

    def compact(self, commits: int = COMMITS) -> bool:
        """A new snapshot, if there are that many commits after the last; whether there is one."""
        tail, snapshots = self._whole("log"), self.snapshots()
        if len(tail) < commits or not tail:
            return False
        number = int(snapshots[-1].rsplit("/", 1)[-1]) + 1 if snapshots else 1
        target = f"{self.path}/snapshots/{number:010d}"
        if not files.claimed(self.spark, f"{self.path}/claims/{number:010d}"):
            return False
        self.last().repartition("source_id").sortWithinPartitions("source_id").write.mode("overwrite").parquet(target)
        for folder in tail:  # those that ``last`` has read, at least
            files.moved(self.spark, folder, folder.replace(f"{self.path}/log/", f"{self.path}/history/"))
        for old in snapshots[:-1]:
            files.removed(self.spark, old)
        return True
