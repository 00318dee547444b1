"""Connected components of an undirected graph, by contraction and alternating stars.

Contraction: each task joins the vertices that its own edges connect, of ``HELD`` vertices at a
time, and links them to their least.  Large star: every vertex links its greater neighbours to the least of its
neighbourhood.  Small star: it links its smaller neighbours, and itself, to their least.  All
leave the components as they are and drive the edges towards stars around each component's
least vertex; the number of rounds grows with the logarithm of the graph's size, and what one
task contracts needs none.  Each round is a minimum per vertex, summed
up before the shuffle, and a join in which hot vertices are broadcast; edges stay distributed,
and each round is written to the shared folder.

Defined results: an edge from a vertex to itself counts for nothing, repeated edges count
once, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import scratch


#: Vertices that a task holds.
HELD = 1 << 20


def _contract(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """A star for each component of the task's edges, of so many of them at a time as ``held`` vertices have."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def stars() -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(found := list(parent)), 1 << 16):
            edges = [(x, r) for x in found[lo : lo + (1 << 16)] if (r := root(x)) != x]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in edges], pa.int64()), pa.array([r for _, r in edges], pa.int64())], names=["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
            if len(parent) >= held:
                yield from stars()
                parent.clear()
    yield from stars()


def _contracted(edges: DataFrame, held: int) -> tuple[DataFrame, tuple]:
    mark = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    return scratch.save_counted(scratch.few(edges).mapInArrow(lambda it: _contract(it, held), "u long, v long"), *mark)


def _large(edges: DataFrame, total: int) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return scratch.look_up(both.where("v > u"), "u", least, "n", 2 * total).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` have u > v; a vertex has no more of them than there were contractions."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, u: str = "u", v: str = "v", held: int = HELD) -> DataFrame:
    """(id, component) of every vertex of an edge between different vertices; component is the least id."""
    now, seen = _contracted(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v"), held)
    before = None
    # one task that held all its vertices at once has made whole stars
    while (scratch.few_partitions(now.sparkSession) > 1 or 2 * seen[0] >= held) and seen[0] and seen != before:
        before = seen
        now, seen = _contracted(_small(_large(now, seen[0])), held)
    stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return stars.union(now.select("v", "v").distinct()).toDF("id", "component")
