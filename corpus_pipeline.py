"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read
again before the next one.  All but the last return the columns of ``docs``, whatever
other columns these have.  A null text counts as the empty one and an empty table gives
an empty one in every stage; texts of any length are taken whole; rows that are equal are
judged alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import decontam, minhash, mixing, qda, scratch, secrets
from lexmill.llm.queries import held_out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier accepts.

    Labels without a document, or of rows without an id, teach nothing; without labels of
    both classes all documents are scored alike, by the share of class 1.  An empty text has a
    score like any other.
    """
    model = qda.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), unpaired=held_out())
    return _with(docs, lambda d: qda.score(d, model).where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies (five-word shingles, 0.8).

    Where rows share an id, each text of the id is a document of its own, and of rows with the
    same id and text the one with the least hash of all columns stays.  Rows without an id,
    and documents without words, stay.
    """
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = minhash.link_components(known, shingle=5).where("kept").select(F.col("id").alias("doc_id"))
        return docs.join(kept, "doc_id", "left_semi").select(*_all(docs)).unionByName(docs.where("doc_id is null"))
    own = F.xxhash64("doc_id", "text")
    texts = known.select(own.alias("own"), "doc_id", "text")
    groups = minhash.link_components(texts, id="own", shingle=5).select(F.col("id").alias("own"), "component_id").distinct()
    least = texts.select("own", "doc_id").join(groups, "own").groupBy("component_id").agg(F.min(F.struct("doc_id", "own")).alias("first"))
    rows = known.select(F.struct(*_all(docs)).alias("row"), own.alias("own"), F.xxhash64(*_all(docs)).alias("tie")).join(least.select("first.own"), "own", "left_semi")
    single = rows.withColumn("nth", F.expr("row_number() over (partition by own order by tie)")).where("nth = 1")
    return single.select(*(F.col("row")[c].alias(c) for c in docs.columns)).unionByName(docs.where("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark; items without a text match nothing."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with(docs, lambda d: decontam.flag(d, benchmark).where("not contaminated"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; every document stays."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*_all(docs)) if "n_chars" in docs.columns else out


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every document in a mix of equal shares of the sources; those without a source are one more source."""
    return mixing.mix(docs)


def _all(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def _with(docs: DataFrame, judged) -> DataFrame:  # noqa: ANN001
    """What ``judged`` keeps of ``docs``, whose columns other than the text it doesn't see by name."""
    names = [c if c == "text" else f"column_{i}" if c != "doc_id" else c for i, c in enumerate(docs.columns)]
    return judged(docs.toDF(*names)).select(*names).toDF(*docs.columns)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontaminated), ("secrets", without_secrets), ("mixing", mixed)]
#: Learned scores and hash-based candidates have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``; scratch tables of the stages before are deleted."""
    before = scratch.written(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        scratch.release(spark, before, docs)
    return docs
