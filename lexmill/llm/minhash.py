"""MinHash near-dedup (operator 4): min-max hashing.

Each permutation of the shingles gives two signature values, its minimum and its maximum,
so ``bands * rows`` values cost half as many hash evaluations.  The signature is cut into
bands; documents that agree in a band meet in its bucket.

Candidates become links only after an exact check on the whole shingle sets, word by word,
and links become components by contraction and alternating stars.  No bucket is gathered in
one task, and none is expanded into pairs:

1. Documents of the same word sequence, told by its SHA-256, form a class, of which the
   smallest id stands for all.
2. Every member of a bucket is checked against the bucket's smallest member, its pivot, if
   the sizes of their sets allow a link.  The smallest pivot of a member comes first; others
   follow if that leaves them apart.
3. In a bucket that still holds several components, those outside the largest one are
   compared with all its members, blocks against blocks in separate tasks, which return
   links only where they join components.  So every possible link of a bucket is checked,
   or lies inside a component.

A link of similarity s is missed only if no band agrees, with probability
(1 - s^rows)^bands: at 0.8 about 3 in a million for 5 rows and 32 bands.  Blocks are cut by
rows and by bytes; hot classes, buckets and pivots are looked up in bounded broadcasts.

Defined results: a null text counts as empty; a document without words is linked with
nothing and kept; one with fewer words than a shingle has its whole sequence as its only
shingle; texts of any length are read whole; rows of equal id each get a row, with the
component of the one whose text hashes least; a row with a null id is linked with nothing,
has a null component and is kept; an empty table gives no rows.  Columns beside the named
ones, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import blobs, components, scratch, words

U64 = np.uint64
ROWS, BANDS = 5, 32
#: A pivot's candidates, and the members of a bucket, are dealt over blocks of about so many rows, and bytes.
STAR, GROUP, GROUP_BYTES = 128, 512, 1 << 24


def signatures(sets: np.ndarray, where: np.ndarray, values: int, seed: int = 1) -> np.ndarray:
    """A row of ``values`` values per set: of each permutation the minimum, then the maximum; empty sets give zeros."""
    half = values // 2
    noise = words.mix(np.arange(1, 2 * half + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    filled = np.flatnonzero(np.diff(where))
    out = np.zeros((len(where) - 1, values), U64)
    step = 1 << 16  # what stays in the cache
    lo = 0
    while lo < len(filled):
        hi = max(lo + 1, int(np.searchsorted(where[filled], where[filled[lo]] + step)))
        own = filled[lo:hi]
        first, last = where[own[0]], where[own[-1] + 1]
        part, at = sets[first:last], where[own] - first
        for p in range(half):
            moved = part * (noise[2 * p] | U64(1))
            moved += noise[2 * p + 1]
            out[own, 2 * p] = np.minimum.reduceat(moved, at)
            out[own, 2 * p + 1] = np.maximum.reduceat(moved, at)
        lo = hi
    return out


def _sequence(text: str | None) -> bytes:
    """A digest of the word sequence."""
    return hashlib.sha256(b" ".join((text or "").encode().lower().split())).digest()


def _profile(batches: Iterator[pa.RecordBatch], shingle: int, rows: int, bands: int) -> Iterator[pa.RecordBatch]:
    """Of each document: size of its shingle set, bytes, digest of its word sequence, and a hash for each band."""
    for batch in words.sliced(batches, 1):
        sets, where = words.shingles(batch.column(1), shingle)
        sizes = np.diff(where)
        digests = [_sequence(x) for x in batch.column(1).to_pylist()]
        length = np.diff(words.text_bytes(batch.column(1))[1])
        values = signatures(sets, where, rows * bands)
        # a band takes values of different permutations: minima in one half of the bands, maxima in the other
        values = np.concatenate([values[:, 0::2], values[:, 1::2]], axis=1).reshape(len(sizes), bands, rows)
        power = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(rows)], U64)
        hashes = words.mix((words.mix(values) * power).sum(axis=2, dtype=U64) + np.arange(bands, dtype=U64))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, hashes.size + 1, bands), pa.int32()), pa.array(hashes.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(digests, pa.binary()), flat],
            names=["id", "hash", "n_shingles", "bytes", "digest", "bands"],
        )


def _check(pairs: pa.Table, shingle: int) -> pa.Table:
    """One pivot's text, in the row without ``other``, against its candidates': sizes of the intersections and unions."""
    ids = pairs["other"].to_pylist()
    base = next(i for i, x in enumerate(ids) if x is None)
    sets, where = words.shingles(pairs["text"], shingle, exact=True)
    own = sets[where[base] : where[base + 1]]
    shared = np.concatenate([[0], np.cumsum(blobs.among(sets, own))])
    inter = shared[where[1:]] - shared[where[:-1]]
    union = len(own) + np.diff(where) - inter
    keep = [i for i, x in enumerate(ids) if x is not None]
    pivot = pairs["pivot"].take(pa.array(keep, pa.int64()))
    return pa.table({"pivot": pivot, "other": pa.array([ids[i] for i in keep], pa.int64()), "inter": pa.array(inter[keep].astype(np.int64)), "total": pa.array(union[keep].astype(np.int64))})


def _blocks(n: Column, size: Column, rows: int = GROUP) -> Column:
    return F.greatest(F.ceil(n / rows), F.ceil(size / GROUP_BYTES)).cast("int")


def _checked(pairs: DataFrame, total: int, texts: DataFrame, shingle: int) -> DataFrame:
    """(pivot, other, inter, total) of each of the ``total`` (pivot, other, bytes); a pivot's pairs are dealt over blocks."""
    count = pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).select("pivot", "n", _blocks(F.col("n"), F.col("bytes"), STAR).alias("groups"))
    dealt = scratch.look_up(pairs.select("pivot", "other"), "pivot", count, "n", total).withColumn("grp", F.pmod(F.xxhash64("other"), F.col("groups")).cast("int"))
    others = dealt.join(texts.withColumnRenamed("id", "other"), "other").select("pivot", "grp", "other", "text")
    pivots = count.join(texts.withColumnRenamed("id", "pivot"), "pivot").select("pivot", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"), F.lit(None).cast("long").alias("other"), "text")
    return others.union(pivots).groupBy("pivot", "grp").applyInArrow(lambda t: _check(t, shingle), "pivot long, other long, inter long, total long")


def _single(profile: DataFrame) -> DataFrame:
    """The rows that take part in links: with an id and words, and one of each id."""
    real = profile.where("id is not null and n_shingles > 0")
    repeated = real.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("hash").alias("least")).where("c > 1").select("id", "least")
    if repeated.isEmpty():
        return real
    return real.join(repeated, "id", "left").where("least is null or hash = least").drop("least").dropDuplicates(["id"])


def link_components(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """(id, n_shingles, component_id, kept) of each row: the components of documents of at least ``percent`` similarity."""
    source = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    hashed = source.select("id", "text", F.xxhash64("text").alias("hash"))
    profile = scratch.save(hashed.mapInArrow(lambda it: _profile(it, shingle, rows, bands), "id long, hash long, n_shingles long, bytes long, digest binary, bands array<long>"))
    real = _single(profile)
    grouped = real.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("n_shingles", "bytes", "bands")))
    classes, (n_classes, n_rows) = scratch.save_counted(grouped, F.count(F.lit(1)).alias("a"), F.sum("n").alias("b"))
    spread = classes.select(F.col("rep").alias("id"), "n_shingles", "bytes", F.explode("bands").alias("bucket"))
    pivot = F.min(F.struct("id", "n_shingles")).alias("p")
    shared = spread.groupBy("bucket").agg(pivot, F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = scratch.save(shared.select("bucket", F.col("p.id").alias("pivot"), F.col("p.n_shingles").alias("pivot_shingles"), "n"))
    buckets, seen = scratch.save_counted(scratch.look_up(spread, "bucket", shared, "n", n_classes), F.count(F.lit(1)).alias("n"))
    named = classes.select("digest", "rep", "n")
    if seen[0]:
        one = hashed.join(buckets.select("id").distinct(), "id").groupBy("id").agg(F.min_by("text", "hash").alias("text"))
        found = _resolved(buckets, shared, n_classes, scratch.save(one), shingle, percent)
        named = named.join(found.toDF("rep", "component"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"), "rep", "n")
    else:
        named = named.withColumn("component", F.col("rep"))
    named = named.where("n > 1 or component <> rep").select("digest", "component", "n")
    members = scratch.look_up(real.select("id", "digest"), "digest", named, "n", n_rows or 0).select("id", "component")
    out = profile.select("id", "n_shingles").join(members, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


class _Links:
    """The pairs tested so far and the components of the links among them."""

    def __init__(self, buckets: DataFrame, shared: DataFrame, total: int, texts: DataFrame, shingle: int, percent: int) -> None:
        self.buckets, self.shared, self.total = buckets, shared, total
        self.texts, self.shingle, self.percent = texts, shingle, percent
        self.tested: list[DataFrame] = []
        self.found: DataFrame | None = None

    def test(self, pairs: DataFrame) -> None:
        """Tests the (pivot, other, bytes) that weren't tested yet."""
        for known in self.tested:
            pairs = pairs.join(known.select("pivot", "other"), ["pivot", "other"], "left_anti")
        pairs, seen = scratch.save_counted(scratch.few(pairs), F.count(F.lit(1)).alias("n"))
        if self.found is not None and not seen[0]:
            return
        new = scratch.save(scratch.few(_checked(pairs, seen[0], self.texts, self.shingle)))
        self.tested.append(new)
        self.merge(new.where(F.col("inter") * 100 >= F.col("total") * self.percent).select("pivot", "other").toDF("u", "v"))

    def merge(self, edges: DataFrame) -> None:
        if self.found is not None:
            edges = edges.union(self.found.where("id <> component"))
        self.found = components.components(edges)

    def label(self, df: DataFrame, column: str) -> DataFrame:
        own = self.found.toDF(column, f"{column}_comp")
        return df.join(own, column, "left").withColumn(f"{column}_comp", F.coalesce(f"{column}_comp", column))

    def stars(self) -> DataFrame:
        """The (bucket, pivot, id, bytes) whose sets are near enough in size for a link."""
        a, b = F.col("n_shingles"), F.col("pivot_shingles")
        return self.buckets.where((F.col("id") != F.col("pivot")) & (F.least(a, b) * 100 >= F.greatest(a, b) * self.percent))

    def away(self, rows: DataFrame) -> DataFrame:
        """Those of a bucket's rows that are in another component than its pivot, with ``id_comp``."""
        pivots = self.label(self.shared.select("bucket", "pivot", "n"), "pivot").select("bucket", "n", "pivot_comp")
        return scratch.look_up(self.label(rows, "id"), "bucket", pivots, "n", self.total).where("id_comp <> pivot_comp")


def _resolved(buckets: DataFrame, shared: DataFrame, total: int, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, component) of the linked among the members of buckets."""
    links = _Links(buckets, shared, total, texts, shingle, percent)
    # the smallest pivot of each member decides most; then those pivots that it left apart
    star = links.stars().groupBy(F.col("id").alias("other")).agg(F.min("pivot").alias("pivot"), F.min("bytes").alias("bytes"))
    links.test(star.select("pivot", "other", "bytes"))
    links.test(links.away(links.stars().select("bucket", "pivot", "id", "bytes")).select("pivot", F.col("id").alias("other"), "bytes").distinct())
    away = scratch.save(links.away(buckets.select("bucket", "id", "bytes")).select("bucket").distinct())
    if not away.isEmpty():
        open_buckets = shared.join(away, "bucket", "left_semi").select("bucket", "n")
        members = scratch.look_up(buckets.select("bucket", "id", "bytes"), "bucket", open_buckets, "n", total)
        links.merge(_block_links(scratch.save(links.label(members, "id")), total, texts, shingle, percent))
    return links.found


def _block_links(members: DataFrame, total: int, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (u, v) that join components inside buckets, of (bucket, id, bytes, n, id_comp).

    Those outside a bucket's largest component are compared with all members.  Both are cut
    into blocks, and a task compares a block with a block; it returns only as many links as
    it joins components.
    """
    parts = members.groupBy("bucket", "id_comp").agg(F.count(F.lit(1)).alias("k"), F.sum("bytes").alias("b"))
    size = parts.groupBy("bucket").agg(F.sum("k").alias("n"), F.sum("b").alias("b"), F.max(F.struct("k", "b", (-F.col("id_comp")).alias("c"))).alias("main"))
    size = size.select("bucket", "n", (-F.col("main.c")).alias("main"), _blocks(F.col("n"), F.col("b")).alias("all_blocks"), _blocks(F.col("n") - F.col("main.k"), F.col("b") - F.col("main.b")).alias("out_blocks"))
    rows = scratch.look_up(members.select("bucket", "id", "id_comp"), "bucket", size, "n", total).join(texts, "id")
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    inner = rows.select("bucket", own("all_blocks").alias("a"), each("out_blocks").alias("b"), "id", "id_comp", F.lit(False).alias("outer"), "text")
    outer = rows.where("id_comp <> main").select("bucket", each("all_blocks").alias("a"), own("out_blocks").alias("b"), "id", "id_comp", F.lit(True).alias("outer"), "text")
    return inner.union(outer).groupBy("bucket", "a", "b").applyInArrow(lambda t: _compare(t, shingle, percent), "u long, v long")


def _compare(t: pa.Table, shingle: int, percent: int) -> pa.Table:
    """The links between a block's outer rows and its others that join components."""
    ids, comps, outer = t["id"].to_numpy(), t["id_comp"].to_numpy(), t["outer"].to_numpy(zero_copy_only=False)
    own, other = np.flatnonzero(outer), np.flatnonzero(~outer)
    sets, where = words.shingles(t["text"], shingle, exact=True)
    sizes = np.diff(where)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(sets, kind="stable")
    first = blobs.runs(sets[order])
    count = np.diff(np.append(first, len(sets)))
    code = np.repeat(np.cumsum(count > 1) - 1, count)  # numbers of shingles that stand in several rows
    shared = np.repeat(count > 1, count)
    row, code = row[order][shared], code[shared]
    place = np.where(outer, np.cumsum(outer), np.cumsum(~outer)) - 1
    inter = np.zeros((len(own), len(other)), np.float32)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        left, right = np.zeros((inter.shape[0], 4096), np.float32), np.zeros((inter.shape[1], 4096), np.float32)
        of, at = row[a:b], code[a:b] - lo
        left[place[of[outer[of]]], at[outer[of]]] = 1
        right[place[of[~outer[of]]], at[~outer[of]]] = 1
        inter += left @ right.T
    total = sizes[own][:, None] + sizes[other][None] - inter
    hit = (inter * 100 >= total * percent) & (comps[own][:, None] != comps[other][None])
    parent: dict[int, int] = {}

    def root(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    found = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        a, b = root(int(comps[own[i]])), root(int(comps[other[j]]))
        if a != b:
            parent[a] = b
            found.append((int(ids[own[i]]), int(ids[other[j]])))
    return pa.table({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([x for _, x in found], pa.int64())})
