"""Quality of many files as a state that merges: only files that are new or changed are read.

Each file has one row of counts, its first missing fields, and its keys' fingerprints with how
often each occurs; a run reads the files whose time or size differ from those in the state,
writes their rows as a part of the state, and merges what the newest part says of each file
that is still there.  Sums, first errors and repeated keys of all files come from these rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scoring import quality_score
from lexmill.functions.text import is_sha256, is_url
from lexmill.operators.profile import missing
from lexmill.operators.quality import DOMAINS, REQUIRED, SHOWN
from lexmill.sources import files

_COUNTS = ("records", "missing", "bad_urls", "bad_hashes", "bad_domains")
_STATE = f"file string, modified timestamp, length long, part long, {', '.join(f'{c} long' for c in _COUNTS)}, first array<struct<ord:long,i:int,field:string>>"
_KEYS = "file string, part long, key long, n long"


class CheckState:
    """The state in a folder, of Parquet files of records that have an order and a key."""

    def __init__(self, spark: SparkSession, path: str, order: str, key: str) -> None:
        self.spark, self.path, self.order, self.key = spark, path.rstrip("/"), order, key

    def _parts(self, kind: str, schema: str) -> DataFrame:
        whole = [f for f in files.listed(self.spark, f"{self.path}/{kind}") if files.exists(self.spark, f"{f}/_SUCCESS")]
        return self.spark.read.schema(schema).parquet(*whole) if whole else self.spark.createDataFrame([], schema)

    def _newest(self) -> DataFrame:
        """What the last part that read it says of each file."""
        rows = self._parts("files", _STATE)
        rest = [c for c in rows.columns if c != "file"]
        return rows.groupBy("file").agg(F.max_by(F.struct(*rest), "part").alias("r")).select("file", *(F.col(f"r.{c}").alias(c) for c in rest))

    def update(self, folder: str) -> int:
        """Reads the files of a folder that are new or changed; how many there are."""
        there = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select(F.col("_metadata.file_path").alias("file"), "path", F.col("modificationTime").alias("modified"), "length")
        known = self._newest().select("file", F.col("modified").alias("__modified"), F.col("length").alias("__length"), "part")
        changed = there.join(known, "file", "left").where("part is null or modified != __modified or length != __length").select("file", "modified", "length", "path").collect()  # names of files
        files.removed(self.spark, f"{self.path}/there")
        there.select("file").write.mode("overwrite").parquet(f"{self.path}/there")
        if changed:
            part = 1 + (self._parts("files", _STATE).agg(F.max("part")).first()[0] or 0)
            named = self.spark.createDataFrame([tuple(r)[:3] for r in changed], "file string, modified timestamp, length long")
            rows = self.spark.read.parquet(*(r["path"] for r in changed)).withColumn("__file", F.col("_metadata.file_path"))
            name = uuid.uuid4().hex
            keyed = rows.groupBy(F.col("__file").alias("file"), F.xxhash64(self.key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
            keyed.select("file", F.lit(part).cast("long").alias("part"), "key", "n").write.parquet(f"{self.path}/keys/{name}")
            counted = named.join(self._counted(rows), "file", "left").withColumn("part", F.lit(part).cast("long"))
            counted = counted.withColumns({c: F.coalesce(c, F.lit(0)) for c in _COUNTS})
            counted.select(*(c.split()[0] for c in _STATE.split(", ")[: 4 + len(_COUNTS)]), "first").write.parquet(f"{self.path}/files/{name}")
        return len(changed)

    def _counted(self, rows: DataFrame) -> DataFrame:
        bad = lambda c, test: F.count_if(~missing(rows, c) & ~test(F.col(c))) if c in rows.columns else F.lit(0).cast("long")
        gaps = F.array_compact(F.array(*(F.when(missing(rows, c), F.struct(F.col(self.order).cast("long").alias("ord"), F.lit(i).alias("i"), F.lit(c).alias("field"))) for i, c in enumerate(REQUIRED))))
        counts = rows.groupBy(F.col("__file").alias("file")).agg(
            F.count(F.lit(1)).alias("records"),
            F.sum(sum((missing(rows, c).cast("long") for c in REQUIRED), F.lit(0))).alias("missing"),
            bad("source_url", is_url).alias("bad_urls"),
            bad("sha256", is_sha256).alias("bad_hashes"),
            bad("domain", lambda c: c.isin(*DOMAINS)).alias("bad_domains"),
        )
        listed = rows.select(F.col("__file").alias("file"), F.explode(gaps).alias("gap"))
        first = F.expr("row_number() over (partition by file order by gap)")
        firsts = listed.withColumn("nth", first).where(F.col("nth") <= SHOWN).groupBy("file").agg(F.array_sort(F.collect_list("gap")).alias("first"))
        return counts.join(firsts, "file", "left")

    def _current(self) -> DataFrame:
        return self._newest().join(self.spark.read.schema("file string").parquet(f"{self.path}/there"), "file", "left_semi")

    def assess(self) -> DataFrame:
        """One row over all files: the counts, the score and the first missing fields."""
        rows = self._current()
        gaps = rows.select(F.explode("first").alias("gap")).orderBy("gap").limit(SHOWN)
        listed = gaps.agg(F.transform(F.array_sort(F.collect_list("gap")), lambda g: F.concat(F.lit("Record "), g["ord"].cast("string"), F.lit(" missing "), g["field"])).alias("first_missing"))
        one = rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _COUNTS)).join(F.broadcast(listed))
        issues = F.size("first_missing") + sum(((F.col(c) > 0).cast("int") for c in _COUNTS[2:]), F.lit(0))
        return one.withColumn("quality_score", F.when(F.col("records") > 0, quality_score(issues, "records")).otherwise(0.0))

    def repeated(self) -> DataFrame:
        """(key, n) of the fingerprints of keys that occur more than once in all files."""
        keys = self._parts("keys", _KEYS).join(self._current().select("file", "part"), ["file", "part"], "left_semi")
        return keys.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
