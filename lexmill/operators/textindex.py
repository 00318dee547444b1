"""A kept index for substring searches: postings of trigrams, appended by segment.

A segment has the texts, sorted by id, and a posting list for each trigram that some of its
tasks' texts hold; a trigram that all texts hold has a list from each task, so none is gathered
in one place.  Lists are dealt to folders by a hash of the trigram: a search reads the folders of
its own trigrams only.  Of these it takes the rarest few, keeps the ids that all of them name,
reads just those texts, and tells by the text whether it holds the query.

Texts are compared in lower case.  A query of fewer than three characters is looked for in all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.sources import files

#: Folders of posting lists, bytes of text whose lists are made at once, trigrams that a search reads, and ids that are named one by one.
FOLDERS, _HELD, RAREST, NAMED = 64, 1 << 24, 4, 4096
_POSTINGS = "gram long, ids array<long>"


def _grams(text: str) -> np.ndarray:
    """The distinct trigrams of a text, as numbers of three code points."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.unique((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams, ids, held = [], [], 0

    def lists() -> pa.RecordBatch:
        gram, own = np.concatenate(grams), np.concatenate(ids)
        order = np.lexsort((own, gram))
        gram, own = gram[order], own[order]
        first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        offsets = pa.array(np.append(first, len(gram)), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(gram[first]), pa.ListArray.from_arrays(offsets, pa.array(own))], names=["gram", "ids"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text and len(text) > 2:
                found = _grams(text)
                grams.append(found)
                ids.append(np.full(len(found), key))
                held += 16 * len(found)
                if held >= _HELD:
                    yield lists()
                    grams, ids, held = [], [], 0
    if held:
        yield lists()


class TextIndex:
    """The index in a folder; texts are (id long, text string)."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def segments(self) -> list[str]:
        """The segments that are there as a whole."""
        return sorted(f.rsplit("/", 1)[-1] for f in files.listed(self.spark, f"{self.path}/texts") if files.exists(self.spark, f"{f}/_SUCCESS"))

    def append(self, texts: DataFrame, segment: str, id: str = "id", text: str = "text") -> None:
        """Adds texts as a segment; one of that name is replaced.  Rows without an id or text are left out.

        The segment counts once its texts are written, which is done last.
        """
        rows = texts.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
        made = rows.select("id", F.lower("text").alias("text")).mapInArrow(_postings, _POSTINGS)
        folder = F.pmod(F.xxhash64("gram"), F.lit(FOLDERS)).cast("int")
        files.removed(self.spark, f"{self.path}/texts/{segment}")
        made.withColumn("folder", folder).repartition("folder", F.pmod(F.xxhash64("ids"), F.lit(8))).sortWithinPartitions("folder", "gram").write.mode("overwrite").partitionBy("folder").parquet(f"{self.path}/postings/{segment}")
        rows.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{self.path}/texts/{segment}")

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{s}" for s in self.segments() if files.exists(self.spark, f"{self.path}/{kind}/{s}/_SUCCESS")]
        parts = [self.spark.read.schema(schema).parquet(p) for p in paths]
        out = parts[0] if parts else self.spark.createDataFrame([], schema)
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def candidates(self, query: str) -> DataFrame:
        """The ids of texts that have the rarest trigrams of a query of three characters and more."""
        grams = _grams(query.lower()).tolist()
        asked = self.spark.createDataFrame([(g,) for g in grams], "gram long").select("gram", F.pmod(F.xxhash64("gram"), F.lit(FOLDERS)).cast("int").alias("folder"))
        folders = sorted({r["folder"] for r in asked.collect()})
        lists = self._read("postings", f"{_POSTINGS}, folder int").where(F.col("folder").isin(folders) & F.col("gram").isin(grams))
        sizes = {r["gram"]: r["n"] for r in lists.groupBy("gram").agg(F.sum(F.size("ids")).alias("n")).collect()}  # the query's trigrams
        if len(sizes) < len(grams):
            return self.spark.createDataFrame([], "id long")
        rarest = sorted(sizes, key=lambda g: (sizes[g], g))[:RAREST]
        named = lists.where(F.col("gram").isin(rarest)).select("gram", F.explode("ids").alias("id"))
        return named.groupBy("id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rarest)).select("id")

    def search(self, query: str) -> DataFrame:
        """(id, text) of the texts that hold the query, in either case."""
        texts, low = self._read("texts", "id long, text string"), query.lower()
        if len(low) > 2:
            found = self.candidates(query)
            some = [r["id"] for r in found.limit(NAMED + 1).collect()]
            # a few ids go into the scan, which skips what can't have them
            texts = texts.where(F.col("id").isin(some)) if len(some) <= NAMED else texts.join(found, "id", "left_semi")
        return texts.where(F.contains(F.lower("text"), F.lit(low)))
