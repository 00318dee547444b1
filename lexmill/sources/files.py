"""Files: JSON arrays, JSON lines with comments, and what a path holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.sources import ranges


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def _at(spark: SparkSession, path: str) -> tuple:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def listed(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, as paths below the path given; nothing if it isn't there."""
    system, target = _at(spark, path)
    return [f"{path.rstrip('/')}/{f.getPath().getName()}" for f in system.listStatus(target)] if system.exists(target) else []


def claimed(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; false if it is there already."""
    system, target = _at(spark, path)
    if not system.exists(target.getParent()):
        system.mkdirs(target.getParent())
    return system.createNewFile(target)


def moved(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file or folder, at once."""
    system, target = _at(spark, to)
    if not system.exists(target.getParent()):
        system.mkdirs(target.getParent())
    system.rename(_at(spark, path)[1], target)


def removed(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.delete(target, True)


def json_array(spark: SparkSession, path: str, schema: T.StructType, size: int = ranges.SIZE) -> DataFrame:
    """The rows of JSON arrays of objects; a missing file, or one that isn't a JSON array as a whole, has none.

    A file is read in ranges of ``size`` bytes, however long it and its lines are.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    fields = T.StructType([*schema, T.StructField("__bad", T.StringType())])
    parsed = ranges.array_objects(spark, path, size).withColumn("row", F.from_json("text", fields, {"columnNameOfCorruptRecord": "__bad"}))
    broken = parsed.where("row.__bad is not null").select("file").distinct()
    # a path a broken file at most, of files that the driver has listed; rows of one file don't meet in a task
    good = parsed.where("row.__bad is null").join(F.broadcast(broken), "file", "left_anti")
    return good.select(*(F.col(f"row.`{f.name}`").alias(f.name) for f in schema))


def json_lines(spark: SparkSession, path: str, schema: T.StructType, numbered: bool = False) -> DataFrame:
    """(file, line, row, bad) of JSON lines, in files that match ``path``; blank and ``#`` lines are skipped.

    ``row`` is null and ``bad`` true where a line isn't JSON.  ``line`` counts from 1 in its file if
    ``numbered``, for which files are read twice; else it is null.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), T.StructField("line", T.LongType()), T.StructField("row", schema), T.StructField("bad", T.BooleanType())]))
    if numbered:
        lines = ranges.numbered_lines(spark, path)
    else:
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.lit(None).cast("long").alias("line"), "value")
    text = F.trim("value")
    lines = lines.select("file", "line", text.alias("text")).where((text != "") & ~text.startswith("#"))
    parsed = F.from_json("text", T.StructType([*schema, T.StructField("__bad", T.StringType())]), {"columnNameOfCorruptRecord": "__bad"})
    out = lines.withColumn("parsed", parsed)
    row = F.when(F.col("parsed.__bad").isNull(), F.struct(*(F.col(f"parsed.{f.name}").alias(f.name) for f in schema)))
    return out.select("file", "line", row.alias("row"), F.col("parsed.__bad").isNotNull().alias("bad"))
