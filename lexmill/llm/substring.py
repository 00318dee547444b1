"""Substring dedup (operator 3): fixed-block anchors.

A window of ``window`` words is a repeat if its word sequence also starts in a document
with a smaller id; every word under a repeat goes.  Windows are judged on the input.

1. *Index and probe.*  Each document is cut into non-overlapping blocks of
   ``(window + 1) // 2`` words; any window holds one of them whole.  The blocks are the
   index, and the rolling windows of that length, in every document, are the probes.  Both
   go to the range of the hash space that their hash falls in.  An anchor is a probe that
   meets an equal block, or a block that meets an equal probe.
2. *Extend.*  Only windows that hold an anchor can be repeats.  They, and nothing else of
   the corpus, go by their own hash to their range, which finds the smallest document of each.  Windows of a greater document are repeats; overlapping ones join
   into maximal repeats.

Documents stay in chunks, one exchange of the texts that all passes reuse.  A chunk and a
range exchange one message (see ``blobs``), where a hash occurs once: a passage shared by
a third of all documents costs a range as many entries as there are chunks at most.

Equality of windows is that of two independent 64-bit hashes of their words, the first of
which tells the range.

Chunks are cut so that one has a bounded number of bytes, as far as the size of the input is
known, and by the session's shuffle partitions otherwise.

Defined results: a null or empty text has no words; a document with fewer words than the
window loses none; texts of any length are read whole; rows with a null id lose none and
take none from others; rows of equal id take nothing from each other; every input row gives
a row, so an empty table gives none.  Columns beside the named ones, whatever their names,
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import blobs, scratch, words

U64 = np.uint64
_MESSAGE = pa.schema([("rng", pa.int32()), ("chunk", pa.int32()), ("n", pa.int32()), ("codes", pa.binary()), ("extra", pa.binary())])
_MESSAGE_SQL = "rng int, chunk int, n int, codes binary, extra binary"
#: The range number of a chunk's note to itself.
_SELF = -1


class _Chunk:
    """The documents of a chunk, in an order that every pass repeats."""

    def __init__(self, table: pa.Table, window: int, ranges: int) -> None:
        order = pc.sort_indices(table, sort_keys=[("id", "ascending"), ("text", "ascending")], null_placement="at_end")
        # offsets of 64 bits: the texts of a chunk may exceed those of 32
        table = table.set_column(table.schema.get_field_index("text"), "text", table["text"].cast(pa.large_string())).take(order).combine_chunks()
        self.texts = table["text"]
        self.ids = table["id"].fill_null(0).to_numpy()
        self.known = table["id"].is_valid().to_numpy()
        self.number = table["chunk"][0].as_py()
        self.window, self.block, self.ranges = window, (window + 1) // 2, ranges
        self.hashes, self.where, self.others = words.tokens(self.texts, second=True)

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, whether it is an index block) of each rolling block-sized window."""
        found, starts = words.windows(self.hashes, self.where, self.block)
        doc = np.searchsorted(self.where, starts, "right") - 1
        keep = self.known[doc]
        found, starts, doc = found[keep], starts[keep], doc[keep]
        return found & ~U64(1), starts, (starts - self.where[doc]) % self.block == 0

    def messages(self, hashes: np.ndarray, codes: np.ndarray, extras: Callable[[int, int], bytes]) -> list[tuple]:
        """A row for each range that has hashes; ``hashes`` ascend, ``extras`` pack a slice."""
        cuts = np.searchsorted(blobs.range_of(hashes, self.ranges), np.arange(self.ranges + 1))
        return [(r, self.number, int(b - a), blobs.pack(codes[a:b]), extras(a, b)) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_MESSAGE)], schema=_MESSAGE)


def _unique_probes(chunk: _Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found, starts, aligned = chunk.probes()
    key = found | aligned.astype(U64)
    key.sort()
    first = blobs.runs(key >> U64(1))
    last = np.append(first[1:], len(key)) - 1 if len(key) else first
    indexed = (key[last] & U64(1)).astype(bool)
    return found, starts, key[first] & ~U64(1), indexed, last > first


def _ask(table: pa.Table, window: int, ranges: int) -> pa.Table:
    """Pass 1: the chunk's distinct probes, and which of them are index blocks."""
    chunk = _Chunk(table, window, ranges)
    _, _, distinct, indexed, _ = _unique_probes(chunk)
    codes = blobs.short_code(distinct, ranges)
    return _rows(chunk.messages(distinct, codes, lambda a, b: blobs.pack_bits(indexed[a:b])))


def _anchors(table: pa.Table) -> pa.Table:
    """In a range: which probes meet an equal one of another chunk, one of all being an index block."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    codes = [blobs.unpack(r["codes"], r["n"], np.uint32) for r in rows]
    indexed = [blobs.unpack_bits(r["extra"], r["n"]) for r in rows]
    merged = np.sort(np.concatenate(codes))
    twice = np.unique(merged[1:][merged[1:] == merged[:-1]])
    blocks = np.unique(np.concatenate([c[x] for c, x in zip(codes, indexed, strict=True)]))
    hit = twice[blobs.among(twice, blocks)]
    return _rows([(r["rng"], r["chunk"], r["n"], blobs.pack_bits(blobs.among(c, hit)), b"") for r, c in zip(rows, codes, strict=True)])


def _candidates(chunk: _Chunk, answers: list[dict]) -> np.ndarray:
    """Whether each window start of the chunk has a window that holds an anchor."""
    found, starts, distinct, indexed, repeated = _unique_probes(chunk)
    hit = indexed & repeated
    rng = blobs.range_of(distinct, chunk.ranges)
    for r in answers:
        a, b = np.searchsorted(rng, [r["rng"], r["rng"] + 1])
        hit[a:b] |= blobs.unpack_bits(r["codes"], r["n"])
    anchor = np.zeros(len(chunk.hashes) + 1, np.int64)
    anchor[starts[blobs.among(found, distinct[hit])]] = 1
    seen = np.concatenate([[0], np.cumsum(anchor)])
    span = chunk.window - chunk.block + 1
    n = max(0, len(chunk.hashes) - chunk.window + 1)
    return (seen[span : span + n] - seen[:n]) > 0


@dataclass(frozen=True)
class _Windows:
    """Candidate windows, ordered by their two hashes."""

    starts: np.ndarray
    ids: np.ndarray  # of the documents
    first: np.ndarray  # where each run of equal windows begins
    hashes: np.ndarray  # of each run
    others: np.ndarray
    least: np.ndarray  # the smallest document of each run


def _wide(chunk: _Chunk, candidate: np.ndarray) -> _Windows:
    found, starts = words.windows(chunk.hashes, chunk.where, chunk.window)
    if len(candidate):
        keep = candidate[starts]
        found, starts = found[keep], starts[keep]
    doc = np.searchsorted(chunk.where, starts, "right") - 1
    keep = chunk.known[doc]
    found, starts, ids = found[keep], starts[keep], chunk.ids[doc[keep]]
    other = words.beside(chunk.others, starts, chunk.window)
    order = _sorted(found, other)
    found, other, starts, ids = found[order], other[order], starts[order], ids[order]
    first = _runs(found, other)
    return _Windows(starts, ids, first, found[first], other[first], np.minimum.reduceat(ids, first) if len(first) else ids)


def _sorted(hashes: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The order by both; the second is looked at only where the first are equal."""
    order = np.argsort(hashes, kind="stable")
    a, b = hashes[order], others[order]
    if (b[1:] < b[:-1])[a[1:] == a[:-1]].any():
        order = np.lexsort((others, hashes))
    return order


def _runs(hashes: np.ndarray, others: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (others[1:] != others[:-1])]))


def _extend(texts: pa.Table, answers: pa.Table, window: int, ranges: int) -> pa.Table:
    """Pass 2: the chunk's distinct candidate windows, each with its second hash and its smallest document."""
    if not texts.num_rows:
        return _MESSAGE.empty_table()
    chunk = _Chunk(texts, window, ranges)
    candidate = _candidates(chunk, answers.to_pylist())
    own = _wide(chunk, candidate)
    rows = chunk.messages(own.hashes, own.hashes, lambda a, b: blobs.pack_plain(np.concatenate([own.others[a:b], own.least[a:b].view(U64)])))
    return _rows([*rows, (_SELF, chunk.number, len(candidate), blobs.pack_bits(candidate), b"")])


def _smallest(table: pa.Table) -> pa.Table:
    """In a range: for which of a chunk's windows another chunk has a smaller document."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    out = [(r["rng"], r["chunk"], r["n"], r["codes"], b"") for r in rows if r["rng"] == _SELF]
    rows = [r for r in rows if r["rng"] != _SELF]
    if rows:
        hashes = np.concatenate([blobs.unpack(r["codes"], r["n"], U64) for r in rows])
        extras = [blobs.unpack_plain(r["extra"], 2 * r["n"], U64) for r in rows]
        others = np.concatenate([x[: len(x) // 2] for x in extras])
        ids = np.concatenate([x[len(x) // 2 :] for x in extras]).view(np.int64)
        order = _sorted(hashes, others)
        first = _runs(hashes[order], others[order])
        best = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(ids))))
        smaller = np.empty(len(ids), bool)
        smaller[order] = best < ids[order]
        cuts = np.cumsum([0] + [r["n"] for r in rows])
        out += [(r["rng"], r["chunk"], r["n"], blobs.pack_bits(smaller[a:b]), b"") for r, a, b in zip(rows, cuts[:-1], cuts[1:], strict=True)]
    return _rows(out)


_RESULT_SQL = "id long, text string, n_words long, removed array<struct<start:long,end:long>>"
_RESULT = pa.schema([("id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _repeats(chunk: _Chunk, answers: list[dict]) -> np.ndarray:
    """Whether each word of the chunk lies under a repeat."""
    note = next(r for r in answers if r["rng"] == _SELF)
    own = _wide(chunk, blobs.unpack_bits(note["codes"], note["n"]))
    smaller = np.zeros(len(own.hashes), bool)
    rng = blobs.range_of(own.hashes, chunk.ranges)
    for r in answers:
        if r["rng"] != _SELF:
            a, b = np.searchsorted(rng, [r["rng"], r["rng"] + 1])
            smaller[a:b] = blobs.unpack_bits(r["codes"], r["n"])
    run = np.repeat(np.arange(len(own.hashes)), np.diff(np.append(own.first, len(own.starts))))
    repeat = smaller[run] | (own.ids > own.least[run])
    at, size = own.starts[repeat], len(chunk.hashes) + 1
    edge = np.bincount(at, minlength=size) - np.bincount(at + chunk.window, minlength=size)
    return np.cumsum(edge[:-1]) > 0


def _apply(texts: pa.Table, answers: pa.Table, window: int, ranges: int) -> pa.Table:
    """Pass 3: the maximal repeats of each document, as ranges of words."""
    if not texts.num_rows:
        return _RESULT.empty_table()
    chunk = _Chunk(texts, window, ranges)
    gone = _repeats(chunk, answers.to_pylist())
    spans = []
    for a, b in zip(chunk.where[:-1].tolist(), chunk.where[1:].tolist(), strict=True):
        turn = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0))
        spans.append([{"start": s, "end": e} for s, e in turn.reshape(-1, 2).tolist()])
    ids = pa.array([i if k else None for i, k in zip(chunk.ids.tolist(), chunk.known, strict=True)], pa.int64())
    whole = pa.table([ids, chunk.texts, pa.array(np.diff(chunk.where), pa.int64()), pa.array(spans, _RESULT.field("removed").type)], names=_RESULT.names)
    _, offsets = words.text_bytes(chunk.texts)
    return pa.concat_tables([whole.slice(a, b - a).cast(_RESULT) for a, b in words.pieces(offsets, 1 << 27)])


#: Bytes of a chunk, about, as files have them: texts are some three times as long in memory.
CHUNK_BYTES = 1 << 25


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = 13, chunks_per_partition: int = 2) -> DataFrame:
    """A row (id, text, n_words, removed) per document; ``removed`` has the maximal repeats as word ranges.

    ``chunks_per_partition`` times the session's shuffle partitions is the least number of
    chunks; tables of files larger than ``CHUNK_BYTES`` for each have more.
    """
    spark = docs.sparkSession
    parts = scratch.partitions(spark)
    ranges = min(parts, 1 << 16)
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    chunks = max(parts * chunks_per_partition, scratch.file_bytes(docs) // CHUNK_BYTES)
    chunk = F.pmod(F.xxhash64(F.coalesce(F.col("id"), F.xxhash64("text"))), F.lit(chunks)).cast("int")
    texts = rows.withColumn("chunk", chunk).repartition(parts, "chunk")
    by_chunk = texts.groupBy("chunk")
    asked = by_chunk.applyInArrow(lambda t: _ask(t, window, ranges), _MESSAGE_SQL)
    anchors = asked.groupBy("rng").applyInArrow(_anchors, _MESSAGE_SQL)
    wide = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(lambda t, a: _extend(t, a, window, ranges), _MESSAGE_SQL)
    home = F.when(F.col("rng") == _SELF, F.col("chunk") % ranges).otherwise(F.col("rng"))
    judged = wide.withColumn("home", home).groupBy("home").applyInArrow(lambda t: _smallest(t.drop_columns(["home"])), _MESSAGE_SQL)
    return by_chunk.cogroup(judged.groupBy("chunk")).applyInArrow(lambda t, a: _apply(t, a, window, ranges), _RESULT_SQL)


def _kept(batches, at_text: int, at_removed: int):
    for batch in batches:
        out = []
        for text, removed in zip(batch.column(at_text).to_pylist(), batch.column(at_removed).to_pylist(), strict=True):
            raw = (text or "").encode()
            starts, ends = words.bounds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            keep = np.ones(len(starts), bool)
            for r in removed:
                keep[r["start"] : r["end"]] = False
            out.append(b" ".join([raw[a:b] for a, b in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.decode() for x in out], pa.string())], names=[*batch.schema.names, "kept_text"])


def kept_text(spans: DataFrame) -> DataFrame:
    """Adds ``kept_text``: the words outside the repeats, joined by one space."""
    names = spans.columns
    at_text, at_removed = names.index("text"), names.index("removed")
    return spans.mapInArrow(lambda it: _kept(it, at_text, at_removed), f"{_RESULT_SQL}, kept_text string")


def digest(spans: DataFrame) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each document; texts stay in the worker."""

    def run(batches):
        for batch in _kept(batches, 1, 3):
            hashes = [hashlib.sha256(x.encode()).hexdigest() for x in batch.column(4).to_pylist()]
            gone = [sum(r["end"] - r["start"] for r in x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(gone, pa.int64()), pa.array(hashes, pa.string())], names=["id", "n_words", "n_removed", "kept_sha256"])

    return spans.mapInArrow(run, "id long, n_words long, n_removed long, kept_sha256 string")
