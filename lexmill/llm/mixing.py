"""Mixing sources to target weights (operator 2): Pfair scheduling of blocks.

The documents of a source, in the order of a hash of their ids, are cut into blocks.  With
weight w, the source's j-th block (from 1) is released at slot floor((j - 1) / w) and due by
slot ceil(j / w); earliest deadline first then gives each slot to one source, and at any time
every source has had its share of the slots to less than one block.

Weights are exact fractions (a float is the decimal it is written as).  Their least common
denominator is the frame after which the schedule repeats, so the slot of any block follows
from its number by arithmetic if the frame is short; a longer schedule is written out, a run
of slots at a time.  When a source has no blocks left, a new phase begins with the weights of
the others in proportion, so that every document is placed once.

The schedule is made by one task out of one row a source, and streamed to a table: all it
holds is a heap with an entry a source, and a run of slots.  Documents are numbered inside
ranges of their hash, whose counts are summed up, so no source is numbered in one task; each
range of a source is joined with the part of the schedule that it needs, where it already is
after the numbering, so the rows move once.

Defined results: a null source counts as the empty one; a source without a weight, or of
weight zero, comes after all others, by equal shares; a weight for a source without documents
is ignored; rows of equal id are placed next to each other as ordered by their other
columns' hash; rows without an id are placed by that hash; texts of any length are only moved;
an empty table gives no rows; columns of the input named as an output column are replaced,
and any other name is kept.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import scratch

BLOCK = 16
#: Slots that are written out at once, and the longest frame that is repeated by arithmetic.
RUN = 8_192


def exact(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in the proportion of the weights."""
    parts = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    common = math.lcm(*(x.denominator for x in parts.values()))
    whole = {s: int(x * common) for s, x in parts.items()}
    least = math.gcd(*whole.values())
    return {s: x // least for s, x in whole.items()}


def earliest_deadline_first(quota: dict[str, int]) -> Iterator[str]:
    """The source of each slot, without an end."""
    frame = sum(quota.values())
    waiting = [(0, s, 1) for s in sorted(quota)]  # by release
    ready: list[tuple[int, str, int]] = []  # by deadline
    t = 0
    while True:
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * frame // quota[s]), s, j))
        due, s, j = heapq.heappop(ready)
        if t >= due:
            raise AssertionError("a block missed its deadline")
        yield s
        heapq.heappush(waiting, (j * frame // quota[s], s, j + 1))
        t += 1


class Part(NamedTuple):
    """The i-th block of a source from ``first`` on, before ``until``, gets slot start + (i // k) * frame + slots[i % k]."""

    source: str
    first: int
    until: int
    start: int
    frame: int
    slots: list[int]


def parts(blocks: dict[str, int], weights: dict[str, float] | None = None, run: int = RUN) -> Iterator[Part]:
    """The schedule of all blocks of all sources."""
    given = {s: 1.0 for s in blocks} if weights is None else {s: weights.get(s, 0.0) for s in blocks}
    left, used, start = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0
    while left:
        quota = exact({s: given[s] for s in left if given[s] > 0} or dict.fromkeys(left, 1.0))
        frame, t = sum(quota.values()), 0
        size = min(frame, run)
        slots: dict[str, list[int]] = {}
        for s in earliest_deadline_first(quota):
            dry = len(slots.get(s, ())) >= left[s]
            if not dry:
                slots.setdefault(s, []).append(t)
                t += 1
                if t < size:
                    continue
            length = t
            if size == frame and not dry:  # repeats, up to the first slot that a source has no block for
                length, dry = min(left[x] // len(own) * frame + own[left[x] % len(own)] for x, own in slots.items()), True
            for x, own in slots.items():
                if taken := length // t * len(own) + sum(i < length % t for i in own):
                    yield Part(x, used[x], used[x] + taken, start, t, own)
                used[x] += taken
                left[x] -= taken
            start += length
            if dry:
                break
            slots, t = {}, 0
        left = {s: n for s, n in left.items() if n}


_PART = pa.schema([("source", pa.string()), ("first", pa.int64()), ("until", pa.int64()), ("start", pa.int64()), ("frame", pa.int64()), ("slots", pa.list_(pa.int64()))])
_PART_SQL = "source string, first long, until long, start long, frame long, slots array<long>"


def _scheduled(batches: Iterator[pa.RecordBatch], weights: dict[str, float] | None) -> Iterator[pa.RecordBatch]:
    blocks = {s: n for batch in batches for s, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)}
    held: list[Part] = []
    for part in parts(blocks, weights):
        held.append(part)
        if sum(len(x.slots) for x in held) >= RUN:
            yield pa.RecordBatch.from_pylist([x._asdict() for x in held], _PART)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([x._asdict() for x in held], _PART)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id: str = "doc_id", source: str = "source", block: int = BLOCK) -> DataFrame:
    """Adds ``block`` (its number in the source), ``place`` (in the block) and ``slot`` (of the block in the mix).

    Without ``weights`` all sources weigh the same.  Sorting by slot and place gives the mix.
    """
    names = [c for c in docs.columns if c not in ("block", "place", "slot")]
    columns = [f"c{i}" for i in range(len(names))]
    ranges = scratch.partitions(docs.sparkSession)
    rows = docs.select(*(F.col(f"`{c}`") for c in names)).toDF(*columns)
    own = F.xxhash64(*(c for c in columns if "map" not in rows.schema[c].dataType.simpleString()))
    order = F.coalesce(F.md5(F.col(columns[names.index(id)]).cast("string").cast("binary")), F.md5(own.cast("string").cast("binary")))
    rows = rows.select("*", F.coalesce(F.col(columns[names.index(source)]).cast("string"), F.lit("")).alias("key"), order.alias("hash"), own.alias("tie"))
    number = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("rng", F.floor(number * ranges / (1 << 32)).cast("int"))
    counts = scratch.save(rows.groupBy("key", "rng").agg(F.count(F.lit(1)).alias("n")))
    supply = counts.groupBy("key").agg(F.ceil(F.sum("n") / block).cast("long").alias("blocks"))
    # one row a source, into one task
    plan = scratch.save(supply.coalesce(1).mapInArrow(lambda it: _scheduled(it, weights), _PART_SQL))
    before = F.expr("sum(n) over (partition by key order by rng rows between unbounded preceding and 1 preceding)")
    offsets = counts.select("key", "rng", "n", F.coalesce(before, F.lit(0)).alias("before"))
    low, high = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("n") - 1) / block)
    needed = offsets.join(plan, (F.col("key") == F.col("source")) & (F.col("first") <= high) & (F.col("until") > low))
    needed = needed.select(F.col("key").alias("of"), F.col("rng").alias("at"), "before", "first", "until", "start", "frame", "slots")
    ranked = rows.withColumn("rank", F.expr("row_number() over (partition by key, rng order by hash, c%d, tie)" % names.index(id)))
    index = F.floor((F.col("rank") + F.col("before") - 1) / block)
    placed = ranked.join(needed, (F.col("key") == F.col("of")) & (F.col("rng") == F.col("at")) & (index >= F.col("first")) & (index < F.col("until")))
    step = index - F.col("first")
    slot = F.col("start") + F.floor(step / F.size("slots")) * F.col("frame") + F.get("slots", (step % F.size("slots")).cast("int"))
    place = ((F.col("rank") + F.col("before") - 1) % block).cast("int")
    return placed.select(*(F.col(c).alias(n) for c, n in zip(columns, names, strict=True)), index.alias("block"), place.alias("place"), slot.alias("slot"))
