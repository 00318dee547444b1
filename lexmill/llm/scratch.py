"""Tables written to the cluster's shared folder, which cut the lineage of iterative jobs.

The folder is the session's ``spark.checkpoint.dir``.  Only a session that runs in one
process (``local[...]``, as in tests) may go without it; then a temporary folder is used.
A written table survives the loss of executors, as every later read goes to shared storage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FEW = 16
_OWN: dict[str, list[str]] = {}
_LOCAL: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder for scratch tables."""
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return found.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="lexmill-")
    return _LOCAL[app]


def few(df: DataFrame) -> DataFrame:
    """``df``, of narrow rows such as edges, in fewer partitions: each has what up to ``FEW`` shuffle partitions have made.

    Short rounds then don't spend their time on creating files.
    """
    return df.repartition(few_partitions(df.sparkSession))


def few_partitions(spark: SparkSession) -> int:
    return max(1, partitions(spark) // FEW)


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder, which ``release`` deletes."""
    path = f"{folder(spark)}/lexmill-{uuid.uuid4().hex}"
    _OWN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def save(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_counted(df: DataFrame, *measures: Column) -> tuple[DataFrame, tuple]:
    """As ``save``, with the values of aggregates over the table, taken while it is written."""
    seen = Observation()
    saved = save(df.observe(seen, *measures))
    return saved, tuple(seen.get.values())


def look_up(rows: DataFrame, key: str, found: DataFrame, n: str, total: float) -> DataFrame:
    """Inner join of ``rows`` with ``found``, which has a row per key and the number ``n`` of its rows among ``total``.

    A key with more rows than a partition has on average is hot.  There are no more of them
    than partitions, so they are looked up in a small broadcast; rows that are found there
    are dealt evenly in the join of the others by key.
    """
    names = [c for c in found.columns if c != key]
    limit = total / partitions(rows.sparkSession)
    hot = found.where(F.col(n) > limit).select(key, *(F.col(c).alias(f"__hot_{c}") for c in names))
    cold = found.where(F.col(n) <= limit).select(F.col(key).alias("__key"), F.lit(False).alias("__hot"), *(F.col(c).alias(f"__cold_{c}") for c in names))
    marked = rows.join(F.broadcast(hot), key, "left")
    is_hot = F.col(f"__hot_{n}").isNotNull()
    dealt = F.xxhash64(*rows.columns).cast("string").cast(rows.schema[key].dataType)
    marked = marked.withColumn("__hot", is_hot).withColumn("__key", F.when(is_hot, dealt).otherwise(F.col(key)))
    out = marked.join(cold, ["__key", "__hot"], "left").where(is_hot | F.col(f"__cold_{n}").isNotNull())
    return out.select(*rows.columns, *(F.coalesce(f"__hot_{c}", f"__cold_{c}").alias(c) for c in names))


def written(spark: SparkSession) -> list[str]:
    """The scratch tables of this application that weren't deleted."""
    return list(_OWN.get(spark.sparkContext.applicationId, ()))


def release(spark: SparkSession, before: list[str] | None = None, keep: DataFrame | None = None) -> None:
    """Deletes the scratch tables of this application; call it once results are written.

    Those written ``before`` stay, as does the table that ``keep`` reads.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    own = _OWN.get(spark.sparkContext.applicationId, [])
    read = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in keep.inputFiles()} if keep is not None else set()
    for path in [p for p in own if p not in (before or ()) and p.rsplit("/", 1)[-1] not in read]:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        own.remove(path)


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions that the session is tuned to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_bytes(df: DataFrame) -> int:
    """The size of the files that a plain read of files has, by the optimizer's statistics; 0 of anything else."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.children().size() == 1:
        plan = plan.children().head()
    return int(str(plan.stats().sizeInBytes())) if plan.nodeName().startswith("Relation") or plan.nodeName() == "LogicalRelation" else 0
