"""Approximate nearest neighbours (operator 7): a hierarchical k-means tree.

The tree is fitted on a bounded sample (``FIT`` vectors, by hash), and then every vector is
assigned to a leaf.  A query walks the tree best bin first: a priority queue holds the
nodes seen so far by the distance of their centre, the nearest is opened next, and leaves
come out in the order in which they are visited.  How many leaves a query visits is
calibrated: for a bounded set of queries the exact neighbours among *all* vectors are
found, and visits widen until the wanted share of them lies in visited leaves.  A query
goes on beyond that number until the visited leaves hold as many candidates as it asks for.

The number of leaves grows with the table, to ``LEAVES``, so that a leaf has about ``LEAF``
vectors; where most of a leaf's vectors are equal, it needs only the smallest ids of them, and
the others are left out (no query can find more than k of them).  Leaves are dealt over tasks in
blocks, by a hash, and so are the queries that visit them, in much larger ones: a task holds a
block of a leaf while the queries pass by in batches, so a vector is sent once for each
``ASKED`` queries of its leaf.  Blocks' best are merged.  Scores are
cosines in double precision of the original vectors.  Nothing that grows with the table
without a bound is broadcast or collected: the tree is at most ``LEAVES`` centres.

Defined results: vectors that are null, empty, zero, of another length than most of the
sample, or that hold null or non-finite components take no part, neither as query nor as
candidate; nor do rows with a null id; ties go to the smaller id; a query finds all
candidates if there are fewer than asked for; rows of equal id are each a candidate, but
never one of a query with that id; columns beside the named ones, whatever their names, are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import scratch

#: Bounds: sampled vectors to fit on, queries to calibrate with, children of a node, leaves.
FIT, CALIBRATE, BRANCH, LEAVES = 40_000, 100, 12, 4_096
#: Vectors of a leaf, as far as the bound on leaves allows, of a block of a leaf, which a task holds, and of a block of its queries, which pass by.
LEAF, BLOCK, ASKED = 512, 4_096, 1 << 17


@dataclass(frozen=True)
class Tree:
    """Nodes by number, the root first; ``leaf`` numbers leaves and is -1 for inner nodes."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by descent to the nearest centre."""
        out = np.zeros(len(unit), np.int64)
        todo = [(0, np.arange(len(unit)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
            elif len(rows):
                own = np.array(self.children[node])
                near = np.argmin(_apart(unit[rows], self.centres[own]), axis=1)
                todo += [(int(own[i]), rows[near == i]) for i in range(len(own))]
        return out

    def walk(self, unit: np.ndarray) -> Iterator[int]:
        """The leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
            else:
                own = self.children[node]
                for d, child in zip(_apart(unit[None], self.centres[list(own)])[0].tolist(), own, strict=True):
                    heapq.heappush(queue, (d, child))


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances without the term that is equal for all centres."""
    return (centres**2).sum(axis=1) - 2 * x @ centres.T


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Centres of up to k clusters, seeded far apart."""
    centres = [x[rng.integers(len(x))]]
    far = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and far.sum() > 1e-9:
        centres.append(x[rng.choice(len(x), p=far / far.sum())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
    out = np.array(centres)
    for _ in range(rounds):
        near = np.argmin(_apart(x, out), axis=1)
        size = np.bincount(near, minlength=len(out))
        total = np.zeros_like(out)
        np.add.at(total, near, x)
        out[size > 0] = total[size > 0] / size[size > 0, None]
    return out


def fit_tree(sample: np.ndarray, leaf_size: int, seed: int = 7) -> Tree:
    """Splits the sample until a node has ``leaf_size`` vectors or the leaves are used up."""
    rng = np.random.default_rng(seed)
    centres, children, rows = [sample.mean(axis=0)], [()], [np.arange(len(sample))]
    open_nodes = [(-len(sample), 0)]
    n_leaves = 1
    while open_nodes and n_leaves + BRANCH - 1 <= LEAVES:
        size, node = heapq.heappop(open_nodes)
        if -size <= leaf_size:
            break
        own = sample[rows[node]]
        made = _kmeans(own, BRANCH, rng)
        if len(made) < 2:
            continue
        near = np.argmin(_apart(own, made), axis=1)
        numbers = []
        for i in range(len(made)):
            numbers.append(len(centres))
            centres.append(made[i])
            children.append(())
            rows.append(rows[node][near == i])
            heapq.heappush(open_nodes, (-len(rows[-1]), numbers[-1]))
        children[node] = tuple(numbers)
        n_leaves += len(made) - 1
    leaf = np.full(len(centres), -1)
    ends = [i for i, c in enumerate(children) if not c]
    leaf[ends] = np.arange(len(ends))
    return Tree(np.array(centres), tuple(children), leaf)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Double-precision rows and whether each may take part."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    n = len(column)
    flat = column.cast(pa.list_(pa.float64()))
    sizes = np.array([-1 if s is None else s for s in flat.value_lengths().to_pylist()], np.int64)
    if width is None:
        positive = sizes[sizes > 0]
        width = int(np.bincount(positive).argmax()) if len(positive) else 0
    out = np.full((n, width), np.nan)
    good = np.flatnonzero(sizes == width)
    if len(good) and width:
        values = flat.take(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(float)
        out[good] = values.reshape(len(good), width)
    fits = np.isfinite(out).all(axis=1) & (np.abs(out).max(axis=1, initial=0) > 0) if width else np.zeros(n, bool)
    return out, fits


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that squares neither overflow nor vanish; cosines stay the same to the last bit."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


_FOUND = "query_id long, vec_id long, score double"


def _rows(parts: list[tuple]) -> pa.Table:
    q, v, s = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})


def _search(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """The k best of a block for each query, ties to the smaller id, in blocks of queries.

    A matrix product tells which may be among the best; their scores are then computed one
    by one, so that equal vectors have equal scores wherever they stand.
    """
    units, sizes = _units(x), np.sqrt((x**2).sum(axis=1))
    parts = []
    for lo in range(0, len(queries), 256):
        rough = _units(queries[lo : lo + 256]) @ units.T
        for row, asked, q in zip(rough, queries[lo : lo + 256], query_ids[lo : lo + 256].tolist(), strict=True):
            row[ids == q] = -np.inf
            least = np.partition(row, len(row) - k)[len(row) - k] - 1e-9 if len(row) > k else -2.0
            near = np.flatnonzero(row >= max(least, -2.0))
            score = (x[near] * asked).sum(axis=1) / (sizes[near] * np.sqrt((asked**2).sum()))
            best = np.lexsort((ids[near], -score))[:k]
            parts.append((np.full(len(best), q), ids[near[best]], score[best]))
    return parts


def _met(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each block for each of its queries; a block's vectors come before its queries."""
    at, ids, x = None, np.zeros(0, np.int64), np.zeros((0, width))
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 5)])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        own, (rows, _) = batch.column(3).to_numpy(zero_copy_only=False), _matrix(batch.column(4), width)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if lo == hi:
                continue
            key, asked = tuple(keys[:3, lo].tolist()), bool(keys[3, lo])
            if key != at:
                at, ids, x = key, np.zeros(0, np.int64), np.zeros((0, width))
            if not asked:
                ids, x = np.concatenate([ids, own[lo:hi]]), np.concatenate([x, rows[lo:hi]])
            elif len(ids):
                yield from _rows(_search(rows[lo:hi], own[lo:hi], x, ids, k)).to_batches()


def search(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 5, modulus: int = 50, recall: float = 0.97, leaf_size: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest of each row whose id is divisible by ``modulus``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where("id is not null and v is not null")
    total = rows.count()
    sample = _sampled(rows, FIT, total, 0).toArrow()
    raw, fits = _matrix(sample["v"])
    width = raw.shape[1]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not fits.any():
        return empty
    sampled = _units(_scaled(raw[fits]))
    # a leaf of the sample stands for so many vectors of the table
    tree = fit_tree(sampled, max(2, leaf_size * len(sampled) // max(total, 1)))
    visits = _calibrated(rows, _sampled(rows.where(F.col("id") % modulus == 0), CALIBRATE, total / modulus, 1), tree, width, k, recall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (x, fit) = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), width)
            ids, x = ids[fit], _scaled(x[fit])
            leaf = tree.assign(_units(x))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, width), pa.int32()), pa.array(x.reshape(-1)))
            digest = pa.array([hashlib.sha256(v.tobytes()).digest() for v in x + 0.0], pa.binary())  # + 0.0: one zero
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), flat, pa.array(leaf, pa.int32()), digest], names=["id", "v", "leaf", "digest"])

    dealt = scratch.save(rows.mapInArrow(deal, "id long, v array<double>, leaf int, digest binary"))
    # of equal vectors the k smallest ids and one for the query's own; of an id no more than k rows
    own = dealt.withColumn("copy", F.expr("row_number() over (partition by digest, id order by leaf)")).where(F.col("copy") <= k)
    there = own.withColumn("nth", F.expr("dense_rank() over (partition by digest order by id)")).where(F.col("nth") <= k + 1)
    there = scratch.save(there.select("id", "v", "leaf"))
    counts = there.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    held = np.zeros(tree.leaves, np.int64)
    for row in counts.collect():  # at most LEAVES rows
        held[row["leaf"]] = row["n"]
    sizes = counts.select("leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asks = []
            for unit, own in zip(_units(_matrix(batch.column(1), width)[0]), batch.column(2).to_pylist(), strict=True):
                asks.append([])
                there = 0
                for leaf_no in tree.walk(unit):
                    if len(asks[-1]) >= visits and there >= k + own:
                        break
                    asks[-1].append(leaf_no)
                    there += held[leaf_no]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(asks, pa.list_(pa.int32()))], names=["id", "v", "asks"])

    queries = dealt.where(F.col("id") % modulus == 0).select("id", "v")
    # rows of the query's own id are no candidates
    queries = queries.join(queries.groupBy("id").agg(F.count(F.lit(1)).alias("own")), "id").mapInArrow(ask, "id long, v array<double>, asks array<int>")
    queries = scratch.save(queries)
    asked = queries.select(F.explode("asks").alias("leaf")).groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("asked_blocks"))
    sizes = F.broadcast(sizes.join(asked, "leaf"))  # at most LEAVES rows
    deal_out = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    there = there.join(sizes, "leaf").select("leaf", deal_out("blocks", 0).alias("block"), each("asked_blocks").alias("asks"), "id", "v", F.lit(False).alias("asked"))
    asked = queries.select("id", "v", F.explode("asks").alias("leaf")).join(sizes, "leaf")
    asked = asked.select("leaf", each("blocks").alias("block"), deal_out("asked_blocks", 1).alias("asks"), "id", "v", F.lit(True).alias("asked"))

    key = ("leaf", "block", "asks")
    met = there.unionByName(asked).repartition(*key).sortWithinPartitions(*key, "asked")
    near = met.mapInArrow(lambda it: _met(it, width, k), _FOUND)
    best = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    return near.withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _sampled(rows: DataFrame, n: int, total: float, salt: int) -> DataFrame:
    """The ``n`` rows of about ``total`` with the smallest hashes; a share that surely holds them is cut out first, so that tasks send few."""
    key = F.xxhash64("id", F.lit(salt))
    share = int(min(1.0, (1.2 * n + 100) / max(total, 1)) * (1 << 40))
    return rows.where(F.pmod(key, F.lit(1 << 40)) < share).orderBy(F.pmod(key, F.lit(1 << 40)), "id").limit(n)


def _calibrated(rows: DataFrame, asked: DataFrame, tree: Tree, width: int, k: int, recall: float) -> int:
    """The number of leaves to visit, so that the calibration queries find the wanted share of their neighbours among all rows."""
    found_rows = asked.toArrow()
    raw, fits = _matrix(found_rows["v"], width)
    if not fits.any():
        return 1
    ids, queries = found_rows["id"].to_numpy()[fits], _scaled(raw[fits])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, (x, fit) = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), width)
            if fit.any():
                x = _scaled(x[fit])
                found = _rows(_search(queries, ids, x, own[fit], k))
                leaf = dict(zip(own[fit].tolist(), tree.assign(_units(x)).tolist(), strict=True))
                yield from found.append_column("leaf", pa.array([leaf[v] for v in found["vec_id"].to_pylist()], pa.int32())).to_batches()

    best = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    found = rows.mapInArrow(exact, f"{_FOUND}, leaf int").withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "leaf").collect()
    place = {q: {leaf: i for i, leaf in enumerate(tree.walk(x))} for q, x in zip(ids.tolist(), _units(queries), strict=True)}
    needed = np.sort([place[r["query_id"]][r["leaf"]] + 1 for r in found])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1
