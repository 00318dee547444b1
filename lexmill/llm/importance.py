"""Target-distribution importance resampling (operator 13): array scores, then radix selection.

Features of a text are its runs of one to ``longest`` consecutive words, hashed into buckets
by CRC-32.  The log ratio of a bucket's share in a target corpus to its share in the table is
its gain; a document's weight is the mean gain of its features, and its score adds Gumbel
noise made of its id.  The documents of the highest scores are a sample without replacement
whose distribution is drawn towards the target.

Weights are computed from arrays over all words of a batch.  The k-th key of (score
descending, id ascending) is found digit by digit: each round counts rows by their next
digit below the digits that are fixed, so the driver sees at most ``2 ** DIGIT`` counts a
round, and no row is moved or sorted for it.  Only the rows that are drawn are then sorted by
range and numbered.

Defined results: a null or empty text has no feature and weight 0; texts of any length are
read whole; repeated rows are judged each; a row without an id has a weight but no score, is
never drawn and not counted among those to draw from; rows of equal score and id are drawn by
weight and number of features, ascending, and rows equal in all of these are interchangeable.
An empty table gives no rows; with an empty target gains come from the table alone.  Only the
columns named are read; others may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import scratch, words

#: Bits of a digit of the selection: at most 65,536 counts reach the driver in a round.
DIGIT = 16
#: A word of more bytes has its checksum computed on its own.
_LONG = 48
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_ONES = np.uint32(0xFFFFFFFF)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> np.uint32(1)) ^ np.uint32(0xEDB88320), _CRC >> np.uint32(1))
#: The order of a draw: the key's columns, and whether they ascend.
_ORDER = (("score", False), ("id", True), ("weight", True), ("n_features", True))


def checksums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of each word's bytes, which go on from the bytes whose CRC-32 is ``before``."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, _LONG + 1), kind="stable")
    at, sizes = starts[order], np.minimum(size[order], _LONG + 1)
    state = np.full(len(at), _ONES) if before is None else before[order] ^ _ONES
    for k in range(min(_LONG, int(sizes.max(initial=0)))):
        n = int(np.searchsorted(-sizes, -k))  # the words of more than k bytes
        state[:n] = _CRC[(state[:n] ^ raw[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out = np.empty(len(at), np.uint32)
    out[order] = state ^ _ONES
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = zlib.crc32(raw[starts[i] + _LONG : ends[i]], int(out[i]))
    return out


def buckets(column: pa.Array | pa.ChunkedArray, longest: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all texts' features, the text of each, and the number of words of each text."""
    raw, offsets = words.text_bytes(column)
    found, owner, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in words.pieces(offsets, words.STEP):
        piece, at = words.LOWER[raw[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends = words.bounds(piece, at, _OUTSIDE)
        where = np.searchsorted(starts, at)
        text = np.repeat(np.arange(lo, hi), np.diff(where))
        counts.append(np.diff(where))
        crc, space = checksums(piece, starts, ends), np.array([0x20], np.uint8)
        for k in range(longest):
            if k:  # a run with one word more: a space, then the word that follows
                inside = text[k:] == text[: len(text) - k]
                crc = np.where(inside, crc[: len(inside)], 0).astype(np.uint32)
                crc = checksums(space, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64), crc)
                crc = checksums(piece, starts[k:], ends[k:], crc)
                found.append((crc[inside] % np.uint32(n)).astype(np.int64))
                owner.append(text[: len(inside)][inside])
            else:
                found.append((crc % np.uint32(n)).astype(np.int64))
                owner.append(text)
    return np.concatenate(found), np.concatenate(owner), np.concatenate(counts)


def _counts(batches: Iterator[pa.RecordBatch], longest: int, n: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(n, np.int64)
    for batch in words.sliced(batches, 0):
        total += np.bincount(buckets(batch.column(0), longest, n)[0], minlength=n)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str, longest: int, n: int) -> np.ndarray:
    """How many features of the whole table each of the ``n`` buckets has."""
    parts = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(lambda it: _counts(it, longest, n), "bucket long, n long")
    out = np.zeros(n, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most n rows
        out[r["bucket"]] = r["n"]
    return out


def gains(table: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousand times the log ratio of each bucket's smoothed shares, rounded down."""
    n, all_table, all_target = len(table), float(table.sum()), float(target.sum())
    ratio = [(t + 1.0) * (all_table + n) / ((s + 1.0) * (all_target + n)) for s, t in zip(table.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weights(batches: Iterator[pa.RecordBatch], gain: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
    for batch in words.sliced(batches, 1):
        found, owner, n_words = buckets(batch.column(1), longest, len(gain))
        n = np.bincount(owner, minlength=batch.num_rows)
        total = np.bincount(owner, gain[found], batch.num_rows).astype(np.int64)  # doubles are exact below 2 ** 53
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(n_words), pa.array(total // np.maximum(n, 1))], names=["id", "n_features", "n_words", "weight"])


def noise(id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, of the first 32 bits of a hash of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _bits(name: str, ascending: bool) -> Column:
    """64 bits whose unsigned order is that of the key."""
    flipped = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
    return flipped if ascending else F.bitwise_not(flipped)


def _as_bits(value: int, ascending: bool) -> int:
    return value + (1 << 63) if ascending else (1 << 63) - 1 - value


def _as_value(bits: int, ascending: bool) -> int:
    return bits - (1 << 63) if ascending else (1 << 63) - 1 - bits


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def kth_key(rows: DataFrame, order: tuple[tuple[str, bool], ...], ranges: list[tuple[int, int]], k: int, digit: int = DIGIT) -> tuple[list[int], int, int]:
    """The key of the ``k``-th row, as far as it takes: values of the first columns, how many rows have them, and how many of these belong to the first ``k``.

    ``order`` names long columns and whether they ascend, ``ranges`` their least and greatest
    values.  Each column is read by digits, the highest first, and a round counts the rows by
    one digit; it ends with the first column after which all rows that share the key are taken.
    """
    values: list[int] = []
    for (name, ascending), ends in zip(order, ranges, strict=True):
        bits = _bits(name, ascending)
        low, high = sorted(_as_bits(x, ascending) for x in ends)
        left = (low ^ high).bit_length()
        prefix, n = low >> left, None
        while left or n is None:
            step = min(digit, left)
            shift = left - step
            inside = rows if left == 64 else rows.where(F.shiftrightunsigned(bits, left) == F.lit(_signed(prefix))) if left else rows.where(bits == F.lit(_signed(prefix)))
            counted = inside.groupBy(F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << step) - 1)).alias("digit")).count()
            for found, n in sorted(tuple(r) for r in counted.collect()):  # noqa: B007
                if k <= n:
                    break
                k -= n
            prefix, left = (prefix << step) | found, shift
        values.append(_as_value(prefix, ascending))
        rows = rows.where(F.col(name) == F.lit(values[-1]))
        if k == n:
            break
    return values, n, k


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, n_buckets: int = 10_000, seed: int = 2024, min_words: int = 20, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's id, n_features, weight, score and rank; the ``percent`` of those with ``min_words`` words that score highest have ranks from 1, others none."""
    gain = gains(bucket_counts(docs, text, longest, n_buckets), bucket_counts(target, text, longest, n_buckets))
    read = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    weighed = read.mapInArrow(lambda it: _weights(it, gain, longest), "id long, n_features long, n_words long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    able = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    names = [name for name, _ in _ORDER]
    ends = [f(F.when(able, F.col(name))).alias(f"{f.__name__}_{name}") for name in names for f in (F.min, F.max)]
    scored, (n, *found) = scratch.save_counted(scored, F.count(F.when(able, 1)).alias("n"), *ends)
    k = percent * n // 100
    plain = [F.col(c) for c in ("id", "n_features", "weight", "score")]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*plain, unranked).withColumnRenamed("id", id)
    values, alike, taken = kth_key(scored.where(able), _ORDER, list(zip(found[::2], found[1::2], strict=True)), k)
    shared = able & reduce(lambda a, b: a & b, (F.col(name) == F.lit(v) for (name, _), v in zip(_ORDER, values, strict=False)))
    before, same = F.lit(False), F.lit(True)
    for (name, ascending), value in zip(_ORDER, values, strict=False):
        before = before | (same & (F.col(name) < value if ascending else F.col(name) > value))
        same = same & (F.col(name) == F.lit(value))
    whole = taken == alike
    drawn = scored.where(able & (before | shared) if whole else able & before).select(*plain)
    others = scored.where(~able | ~(before | shared)).select(*plain)
    if not whole:  # rows equal in every column of the result
        spark = docs.sparkSession
        copies = lambda m: spark.range(m).select(*(F.lit(v).cast("long").alias(name) for (name, _), v in zip(_ORDER, values, strict=True))).select(*plain)
        drawn, others = drawn.unionByName(copies(taken)), others.unionByName(copies(alike - taken))
    return ranked(drawn).select(*plain, "rank").unionByName(others.select(*plain, unranked)).withColumnRenamed("id", id)


def ranked(drawn: DataFrame) -> DataFrame:
    """Numbers rows in the order of a draw: sorted by range, numbered inside each range, and moved by the number of rows in earlier ranges."""
    ordered = drawn.orderBy(*(F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in _ORDER))
    placed = scratch.save(ordered.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())  # a row a partition
    starts, total = [], 0
    for number, n in sizes:
        starts.append((number, total))
        total += n
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("start", T.LongType())])
    offsets = drawn.sparkSession.createDataFrame(starts, schema)
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("part", "start", "at")
