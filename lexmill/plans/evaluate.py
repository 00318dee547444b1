"""Evaluation of answers: graded samples and grouped metrics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.scoring import grade
from lexmill.functions.text import filled
from lexmill.sources.files import json_lines

SAMPLE = (
    "messages array<struct<role:string,content:string>>, metadata struct<domain:string,task:string,source_ids:array<string>,locale:string,split:string>, "
    "expected_output string, eval_criteria struct<must_include:array<string>,citation_required:boolean,max_tokens:int>"
)
GATE = 0.90


def load(spark: SparkSession, pattern: str) -> DataFrame:
    """The samples of all matching files, in order, with ``sample_no`` from 0; lines that aren't JSON are skipped.

    The numbers need all samples in one order; evaluation sets are made by hand and small.
    """
    lines = json_lines(spark, pattern, T.StructType.fromDDL(SAMPLE), numbered=True).where("not bad")
    return lines.withColumn("sample_no", F.expr("row_number() over (order by file, line) - 1")).select("sample_no", "row.*")


def question(messages: Column) -> Column:
    """The first user message; empty without one."""
    return filled(F.get(F.filter(messages, lambda m: m["role"] == "user"), F.lit(0))["content"])


def infer(samples: DataFrame, model: Callable[[str, str], str]) -> DataFrame:
    """Adds ``predicted``: the model's answer to (question, system prompt), in Arrow batches."""
    schema = T.StructType([*samples.schema, T.StructField("predicted", T.StringType())])
    asked = samples.select("*", question(F.col("messages")).alias("__q"), filled(F.get("messages", F.lit(0))["content"]).alias("__s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = [model(q, s) for q, s in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(said, pa.string())], names=schema.fieldNames())

    return asked.mapInArrow(run, schema)


def mock(question: str, system: str) -> str:
    """A stand-in for a model."""
    return f"MOCK_RESPONSE: {question}"


def results(samples: DataFrame, model: Callable[[str, str], str] | None = mock) -> DataFrame:
    """A graded row per sample; without a model the expected answer is graded."""
    rows = infer(samples, model) if model else samples.withColumn("predicted", filled("expected_output"))
    criteria = F.col("eval_criteria")
    keywords = F.coalesce(criteria["must_include"], F.array().cast("array<string>"))
    scores = grade("predicted", "expected_output", keywords, F.coalesce(criteria["citation_required"], F.lit(True)), F.coalesce(criteria["max_tokens"], F.lit(300)))
    return rows.select(
        F.concat_ws("_", "metadata.task", F.col("sample_no").cast("string")).alias("sample_id"),
        "sample_no",
        F.col("metadata.domain").alias("domain"),
        F.col("metadata.task").alias("task"),
        question(F.col("messages")).alias("question"),
        filled("expected_output").alias("expected"),
        "predicted",
        scores.alias("s"),
    ).select("sample_id", "sample_no", "domain", "task", "question", "expected", "predicted", "s.*")


def metrics(graded: DataFrame) -> DataFrame:
    """(task, domain, count, overall_score, accuracy, citation_coverage, avg_length_tokens, pass_rate): over all, by task and by domain in one pass."""
    sets = [[F.col("task")], [F.col("domain")], []]
    return graded.groupingSets(sets, "task", "domain").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg("overall").alias("overall_score"),
        F.avg("accuracy").alias("accuracy"),
        F.avg("citation").alias("citation_coverage"),
        F.avg("token_count").alias("avg_length_tokens"),
        F.avg((F.col("status") == "pass").cast("int")).alias("pass_rate"),
    )


def failed(graded: DataFrame, shown: int | None = None) -> DataFrame:
    out = graded.where("status = 'fail'").orderBy("sample_no")
    return out.limit(shown) if shown else out


def passes(graded: DataFrame, gate: float = GATE) -> bool:
    """Whether enough samples pass."""
    rate = graded.agg(F.avg((F.col("status") == "pass").cast("int"))).first()[0]
    return rate is not None and rate >= gate
