"""Benchmark decontamination (operator 5): latent semantic retrieval.

Documents are read as overlapping passages.  Over the terms of the benchmark, TF-IDF rows
of all passages of the corpus, and of the benchmark itself, make a matrix whose leading
right singular vectors come from a distributed randomised SVD: every task multiplies its
rows by a random matrix and the result by their transpose, and the partial products are
summed by blocks of terms, in lanes first; in a second pass the rows are projected onto an
orthonormal basis of the sum, and the small matrix of their products is decomposed.  Passages and items are projected onto these vectors; an item
whose cosine with a passage is high is a candidate, and counts as a paraphrase if the longest
common subsequence of the item's words and the words around the passage has ``PARAPHRASE`` of
the item.

A term's weight goes by how often it stands elsewhere than beside a word that is its neighbour
in an item, and is never zero: a document's verdict doesn't hang on how many others hold the item.

Cosines miss short items among many other words.  So each place where enough of an item's
rarest words stand close together is a candidate too, of which more is asked: ``SHARE`` of the
item in the common subsequence, or ``SHARE_WITH_ANSWER`` with the item's answer (its last
sentence) there word by word.  Such a subsequence can't do without these words, so no verbatim
item is missed.  Items without enough rare words are compared with all places at once: by a
matrix product how many of their words a place can have in common with them, and where that
is enough by the subsequence, for all such places together.

Words outside the benchmark can't be part of a common subsequence, so the restricted
sequences give it exactly.  A benchmark is taken in slices of ``ITEMS`` items, each with its
own model of at most ``TERMS`` terms (rows of ``RANK`` floats); a slice with more is cut
further.  ``SLICES`` models at most are on the driver, or sent to tasks, at a time: a larger
benchmark is taken in several passes, between which the documents are written.  Counts and
the SVD cover all documents.

Defined results: null and empty texts are clean; texts of any length are read whole; null and
empty items, and items without an id, match nothing; repeated items are one; an item shorter
than ``SHORT`` words matches only as a whole run of words, one shorter than ``LOOSE`` not as
a paraphrase; of several items the one with the greatest share, then the smallest id, is
named; every input row gives a row, repeated ones alike; empty tables give no rows, or clean
ones; columns of the input named as an output column are replaced, and any other name is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import blobs, scratch, words

U64 = np.uint64
#: A passage has two strides of words.
STRIDE = 32
ITEMS, TERMS, RANK, OVERSAMPLE, SLICES = 2_000, 60_000, 64, 8, 4
#: How much the benchmark weighs in the matrix against the whole corpus, so that its directions lead.
WEIGHT = 4.0
#: The least weight of a term, beside the logarithm of its rarity.
FLOOR = 0.1
#: Terms in more than this share of the strides are counted in dense rows, and aren't looked up as an item's rare words.
COMMON = 0.05
#: A candidate has this cosine, and holds this part of the item's weight, at least.
COSINE, PART = 0.6, 0.5
#: Of the words that a match needs, this share is looked for among the item's rarest; any share finds all, a greater one has fewer false candidates.
RARE = 0.5
#: The least share of an item that its rare words have to add to every match, for the item to be looked up by them.
FEW = 0.1
#: The shares of an item that the common subsequence has to reach, without and with the answer.
SHARE, SHARE_WITH_ANSWER = 0.75, 0.6
#: The share that is enough where the cosine is high.
PARAPHRASE = 0.5
SHORT, LOOSE = 8, 16
#: Words between the places at which frequent items are looked for, strides that are multiplied at a time, counts that are compared at a time, and bits of a sequence.
GRAIN, _PLACES, _CELLS, _BITS = 32, 2048, 1 << 21, 64
#: Rows of a sum in a part, groups of tasks whose parts are added up first, and rows added up one after another.
_BLOCK, LANES, _PIECE = 512, 64, 32
_HITS = 1 << 22


@dataclass(frozen=True)
class Items:
    """A slice of the benchmark: its terms, and the items as term numbers."""

    ids: tuple[int, ...]
    vocabulary: np.ndarray
    sequences: tuple[np.ndarray, ...]
    answers: tuple[np.ndarray, ...]


@dataclass(frozen=True)
class Anchors:
    """The rarest words of each item: ``need`` of them stand within ``span`` words wherever the item is found."""

    start: np.ndarray  # of each term its first place in owner, and the end
    owner: np.ndarray
    need: np.ndarray
    span: np.ndarray


@dataclass(frozen=True)
class Weights:
    """Of each term its weight, and its number among the common ones, or -1."""

    idf: np.ndarray
    common: np.ndarray

    @classmethod
    def of(cls, df: np.ndarray, total: int) -> Weights:
        often = df > np.maximum(COMMON * total, 50)
        return cls(np.log((total + 1) / (df + 1)) + FLOOR, np.where(often, np.cumsum(often) - 1, -1))


@dataclass(frozen=True)
class Frequent:
    """Items without enough rare words, over their own terms; ``local`` numbers these."""

    local: np.ndarray
    items: np.ndarray
    least: np.ndarray  # words that have to be in common
    reach: np.ndarray
    counts: np.ndarray  # an item's row of how often it has each term
    masks: np.ndarray  # of each item and term the places in the item, as bits; the last term is no term


@dataclass(frozen=True)
class Model:
    items: Items
    anchors: Anchors
    frequent: Frequent | None
    weights: Weights
    basis: np.ndarray  # terms x rank, times idf
    latent: np.ndarray  # a unit row per item passage
    size: np.ndarray  # its length before
    owner: np.ndarray  # the item of each


def _slices(benchmark: DataFrame, id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("id is not null and trim(text) <> ''").distinct()
    held, size = [], 0
    for row in rows.orderBy("id", "text").toLocalIterator():
        n = len(row["text"].split())
        if held and (len(held) >= ITEMS or size + n > TERMS):
            yield held
            held, size = [], 0
        held.append((row["id"], row["text"]))
        size += n
    if held:
        yield held


def _read(items: list[tuple[int, str]]) -> Items:
    hashes, where = words.tokens(pa.array([t for _, t in items], pa.large_string()), lower=True)
    vocabulary = np.unique(hashes)
    numbers = np.searchsorted(vocabulary, hashes)
    sequences = [numbers[a:b] for a, b in zip(where[:-1], where[1:], strict=True)]
    last = []
    for (_, text), own in zip(items, sequences, strict=True):
        raw = [x for x in text.replace("\n", " ").split(" ") if x]
        cut = max((i + 1 for i, x in enumerate(raw[:-1]) if x[-1:] in ".?!"), default=0)
        last.append(own[-(len(raw) - cut) :] if 0 < len(raw) - cut <= len(own) else own)
    return Items(tuple(i for i, _ in items), vocabulary, tuple(sequences), tuple(last))


def _restricted(hashes: np.ndarray, where: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(term, position, document) of each word that is a term, and the number of words of each document."""
    door = np.zeros(1 << 16, bool)
    door[vocabulary & U64(0xFFFF)] = True
    some = np.flatnonzero(door[hashes & U64(0xFFFF)])
    at = np.minimum(np.searchsorted(vocabulary, hashes[some]), len(vocabulary) - 1)
    fits = vocabulary[at] == hashes[some]
    some, term = some[fits], at[fits]
    doc = np.searchsorted(where, some, "right") - 1
    return term, some - where[doc], doc, np.diff(where)


def _strides(position: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each word's stride, and the first stride of each document; a document ends with an empty stride."""
    count = -(-sizes // STRIDE) + 1
    first = np.concatenate([[0], np.cumsum(count)])
    return first[doc] + position // STRIDE, first


def _run_sums(table: np.ndarray, index: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of ``table[index]`` over each run of the index; runs begin at ``first``.

    Rows are added for all runs at once: their first, second and further ones, in pieces of runs.
    """
    size = np.diff(np.append(first, len(index)))
    pieces = -(-size // _PIECE)
    at = np.cumsum(pieces) - pieces
    before = (np.arange(pieces.sum()) - np.repeat(at, pieces)) * _PIECE
    start, count = np.repeat(first, pieces) + before, np.minimum(np.repeat(size, pieces) - before, _PIECE)
    order = np.argsort(-count, kind="stable")
    start, count = start[order], count[order]
    out = table[index[start]]
    for k in range(1, int(count[0])):
        more = int(np.searchsorted(-count, -k))
        out[:more] += table[index[start[:more] + k]]
    sums = np.empty_like(out)
    sums[order] = out
    return sums if len(sums) == len(first) else np.add.reduceat(sums, at, axis=0)


def _dense(common: np.ndarray, stride: np.ndarray, n: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """How often each stride has each common term, some strides at a time; ``stride`` ascends."""
    for lo in range(0, n, _PLACES):
        a, b = np.searchsorted(stride, [lo, lo + _PLACES])
        hi = min(n, lo + _PLACES)
        yield lo, hi, np.bincount((stride[a:b] - lo) * width + common[a:b], minlength=(hi - lo) * width).reshape(hi - lo, width).astype(np.float32)


def _summed(table: np.ndarray, weights: Weights, term: np.ndarray, stride: np.ndarray, n: int) -> np.ndarray:
    """The table's rows of the terms summed by stride (which ascends), then each stride with the next: a row per passage."""
    out = np.zeros((n + 1, table.shape[1]), table.dtype)
    often = weights.common[term] >= 0
    rare = np.flatnonzero(~often)
    if len(rare):
        first = blobs.runs(stride[rare])
        out[stride[rare][first]] = _run_sums(table, term[rare], first)
    if len(rare) < len(term):
        terms = np.flatnonzero(weights.common >= 0)
        for lo, hi, counts in _dense(weights.common[term[often]], stride[often], n, len(terms)):
            out[lo:hi] += counts @ table[terms]
    return out[:-1] + out[1:]


def _neighbours(items: Items) -> np.ndarray:
    """The pairs of terms that stand side by side in an item, as numbers."""
    pairs = [own[:-1] * len(items.vocabulary) + own[1:] for own in items.sequences]
    return np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))


def _beside(term: np.ndarray, position: np.ndarray, doc: np.ndarray, pairs: np.ndarray, n: int) -> np.ndarray:
    """Whether each word stands beside one that is its neighbour in an item."""
    both = (doc[1:] == doc[:-1]) & (position[1:] == position[:-1] + 1) & blobs.among(term[:-1] * n + term[1:], pairs)
    return np.append(both, False) | np.append(False, both)


def _sequences(batches: Iterator[pa.RecordBatch], vocabularies: list[np.ndarray], pairs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Of each batch a row for each slice: how many strides, and its restricted sequence by stride, with a bit for neighbours."""
    for batch in words.sliced(batches, 0):
        hashes, where = words.tokens(batch.column(0), lower=True)
        for number, vocabulary in enumerate(vocabularies):
            term, position, doc, sizes = _restricted(hashes, where, vocabulary)
            stride, first = _strides(position, doc, sizes)
            beside = _beside(term, position, doc, pairs[number], len(vocabulary)) if len(term) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([int(first[-1])], pa.int64()),
                    pa.array([len(term)], pa.int64()),
                    pa.array([blobs.pack_plain((2 * term + beside).astype(np.uint32))], pa.binary()),
                    pa.array([blobs.pack(stride.astype(np.uint32))], pa.binary()),
                ],
                names=["slice", "strides", "n", "terms", "at"],
            )


def _open(batches: Iterator[pa.RecordBatch], apart: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slice, number of strides, terms and their strides; only of words without a neighbour, if they are to be ``apart``."""
    for batch in batches:
        for row in batch.to_pylist():
            term, stride = blobs.unpack_plain(row["terms"], row["n"], np.uint32), blobs.unpack(row["at"], row["n"], np.uint32)
            if apart:
                term, stride = term[term & 1 == 0], stride[term & 1 == 0]
            yield row["slice"], row["strides"], (term >> 1).astype(np.int64), stride.astype(np.int64)


def _document_counts(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    total = [np.zeros(n, np.int64) for n in sizes]
    for number, _, term, stride in _open(batches, apart=True):
        n = sizes[number]
        pair = np.sort(stride * n + term)
        total[number] += np.bincount(pair[blobs.runs(pair)] % n, minlength=n)
    for number, own in enumerate(total):
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), number, np.int32)), pa.array(some), pa.array(own[some])], names=["slice", "term", "df"])


def _products(batches: Iterator[pa.RecordBatch], weights: list[Weights], seed: int, width: int) -> Iterator[pa.RecordBatch]:
    """The task's part of (transpose of A) A R for each slice, by blocks of terms."""
    total: dict[int, np.ndarray] = {}
    random: dict[int, np.ndarray] = {}
    for number, strides, term, stride in _open(batches):
        if number not in total:
            random[number] = _random(seed, weights[number].idf, width)
            total[number] = np.zeros(random[number].shape)
        total[number] += _product(term, stride, strides, weights[number], random[number])
    for number, own in total.items():
        yield from _parts(number, own)


def _parts(number: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's part of a sum, by blocks of rows; its lane tells which tasks are added up first."""
    context = TaskContext.get()
    lane = context.partitionId() % LANES if context else 0
    for lo in range(0, len(total), _BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) for x in (number, lo // _BLOCK, lane)] + [pa.array([total[lo : lo + _BLOCK].tobytes()], pa.binary())], names=["slice", "block", "lane", "part"])


def _grams(batches: Iterator[pa.RecordBatch], bases: list[np.ndarray], weights: list[Weights]) -> Iterator[pa.RecordBatch]:
    """The task's part of the products of the passages, projected onto each slice's basis."""
    total = [np.zeros((b.shape[1], b.shape[1])) for b in bases]
    for number, strides, term, stride in _open(batches):
        passages = _summed(bases[number], weights[number], term, stride, strides)
        total[number] += passages.T @ passages
    for number, own in enumerate(total):
        yield from _parts(number, own)


def _added(parts: DataFrame, shapes: list[tuple[int, int]]) -> list[np.ndarray]:
    """The sums of the tasks' parts, of a slice each."""
    for keys in (("slice", "block", "lane"), ("slice", "block")):
        parts = parts.groupBy(*keys).applyInArrow(_add, "slice int, block int, lane int, part binary")
    out = [np.zeros(shape) for shape in shapes]
    for row in parts.toArrow().to_pylist():
        lo, own = row["block"] * _BLOCK, out[row["slice"]]
        own[lo : lo + _BLOCK] = np.frombuffer(row["part"]).reshape(-1, own.shape[1])
    return out


def _random(seed: int, idf: np.ndarray, width: int) -> np.ndarray:
    n = len(idf)
    return (np.random.default_rng(seed).standard_normal((n, min(width, n))) * idf[:, None]).astype(np.float32)


def _product(term: np.ndarray, stride: np.ndarray, strides: int, weights: Weights, weighed: np.ndarray) -> np.ndarray:
    """``weighed`` are the rows of the random matrix times the terms' idf."""
    out = np.zeros(weighed.shape)
    if not len(term):
        return out
    passages = _summed(weighed, weights, term, stride, strides)
    both = passages.copy()
    both[1:] += passages[:-1]  # a word counts in the passage that begins with its stride and in the one before
    often = weights.common[term] >= 0
    if often.any():
        terms = np.flatnonzero(weights.common >= 0)
        for lo, hi, counts in _dense(weights.common[term[often]], stride[often], strides, len(terms)):
            out[terms] += counts.T @ both[lo:hi]
    rare = np.flatnonzero(~often)
    if len(rare):
        order = rare[np.argsort(term[rare], kind="stable")]
        own = term[order]
        first = blobs.runs(own)
        out[own[first]] += _run_sums(both, stride[order], first)
    return out * weights.idf[:, None]


def _add(parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x) for x in parts["part"].to_pylist())
    return pa.table({**{c: parts[c].slice(0, 1) for c in ("slice", "block", "lane")}, "part": pa.array([total.tobytes()], pa.binary())})


def _item_strides(items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    term = np.concatenate(items.sequences)
    sizes = np.array([len(s) for s in items.sequences])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    position = np.concatenate([np.arange(n) for n in sizes])
    stride, first = _strides(position, doc, sizes)
    return term, stride, first, np.repeat(np.arange(len(sizes)), np.diff(first))


def _reach(size: int) -> int:
    """The words among which an item's common subsequence is looked for."""
    return size if size < SHORT else size + max(4, size // 4)


def _least(n: int) -> int:
    """The words that an item of n words has to have in common with a text."""
    return n if n < SHORT else int(np.ceil(SHARE_WITH_ANSWER * n - 1e-9))


def _frequent(items: Items, own: list[int]) -> Frequent | None:
    """The items ``own``, for a comparison with all places."""
    if not own:
        return None
    terms = np.unique(np.concatenate([items.sequences[i] for i in own]))
    local = np.full(len(items.vocabulary), -1)
    local[terms] = np.arange(len(terms))
    sizes = np.array([len(items.sequences[i]) for i in own])
    counts, masks = np.zeros((len(own), len(terms)), np.int64), np.zeros((len(own), len(terms) + 1), U64)
    for row, i in enumerate(own):
        sequence = local[items.sequences[i]]
        np.add.at(counts[row], sequence, 1)
        if len(sequence) <= _BITS:
            np.bitwise_or.at(masks[row], sequence, U64(1) << np.arange(len(sequence)).astype(U64))
    return Frequent(local, np.array(own), np.array([_least(n) for n in sizes.tolist()]), np.array([_reach(n) for n in sizes.tolist()]), counts, masks)


def _anchors(items: Items, df: np.ndarray, weights: Weights) -> tuple[Anchors, list[int]]:
    """The rare words of the items, and the items that lack them.

    With ``least`` of n words in common, at least m - (n - least) of any m of them are.
    """
    terms, owners, lacking = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    need, span = np.ones(len(items.ids), np.int64), np.ones(len(items.ids), np.int64)
    for i, own in enumerate(items.sequences):
        n = len(own)
        if not n:
            continue
        least = _least(n)
        distinct, count = np.unique(own, return_counts=True)
        order = np.argsort(df[distinct], kind="stable")
        held = np.cumsum(count[order])
        # no more than the rare ones, of which enough have to be there
        cut = int(np.searchsorted(held, n - least + int(np.ceil(RARE * least))))
        cut = min(cut, int((weights.common[distinct] < 0).sum()) - 1)
        if cut < 0 or held[cut] - (n - least) < max(1, FEW * n):
            lacking.append(i)
            continue
        need[i], span[i] = held[cut] - (n - least), _reach(n)
        terms.append(distinct[order[: cut + 1]])
        owners.append(np.full(cut + 1, i))
    term, owner = np.concatenate(terms), np.concatenate(owners)
    order = np.argsort(term, kind="stable")
    return Anchors(np.searchsorted(term[order], np.arange(len(df) + 1)), owner[order], need, span), lacking


def _anchored(anchors: Anchors, term: np.ndarray, position: np.ndarray, doc: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """(passage, item) wherever enough rare words of an item stand close together."""
    gap = int(anchors.span.max(initial=0)) + 1
    offset = np.concatenate([[0], np.cumsum(sizes + gap)])  # no window reaches into the next document
    count = anchors.start[term + 1] - anchors.start[term]
    some = np.flatnonzero(count)
    term, place, count = term[some], position[some] + offset[doc[some]], count[some]
    ends = np.cumsum(count)
    lo = 0
    while lo < len(term):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _HITS, "right")))
        back = int(np.searchsorted(place, place[lo] - gap))  # what began before is seen whole
        own = count[back:hi]
        at = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        item = anchors.owner[np.repeat(anchors.start[term[back:hi]], own) + at]
        hit = np.sort(item * offset[-1] + np.repeat(place[back:hi], own))
        item, where = hit // offset[-1], hit % offset[-1]
        last = np.arange(len(hit)) + anchors.need[item] - 1
        inside = last < len(hit)
        inside[inside] = hit[last[inside]] - hit[inside] < anchors.span[item[inside]]
        item, where, last = item[inside], where[inside], where[np.minimum(last[inside], len(hit) - 1)]
        d = np.searchsorted(offset, where, "right") - 1
        # the window begins after last - span, and no later than the first
        a = np.maximum(last - anchors.span[item] + 1 - offset[d], 0) // STRIDE + first[d]
        b = (where - offset[d]) // STRIDE + first[d]
        if len(item):
            n = b - a + 1
            passage = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            for pair in np.unique(passage * len(anchors.need) + np.repeat(item, n)).tolist():
                yield divmod(pair, len(anchors.need))
        lo = hi


def fit(docs: DataFrame, slices: list[list[tuple[int, str]]], text: str = "text", rank: int = RANK, seed: int = 11) -> list[Model]:
    """The latent spaces of some slices of the benchmark and the whole corpus, which is read once."""
    reads = [_read(items) for items in slices]
    vocabularies = [r.vocabulary for r in reads]
    sizes = [len(v) for v in vocabularies]
    column = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    pairs = [_neighbours(r) for r in reads]
    rows = scratch.save(column.mapInArrow(lambda it: _sequences(it, vocabularies, pairs), "slice int, strides long, n long, terms binary, at binary"))
    counted = rows.mapInArrow(lambda it: _document_counts(it, sizes), "slice int, term long, df long").groupBy("slice", "term").agg(F.sum("df").alias("df")).toArrow()
    total = rows.where("slice = 0").agg(F.sum("strides")).first()[0] or 0
    dfs = [np.zeros(n) for n in sizes]
    for number, df in enumerate(dfs):
        own = counted.filter(pc.equal(counted["slice"], number))
        df[own["term"].to_numpy()] = own["df"].to_numpy()
    weights = [Weights.of(df, total) for df in dfs]
    width = rank + OVERSAMPLE
    products = _added(rows.mapInArrow(lambda it: _products(it, weights, seed, width), _PART), [(n, min(width, n)) for n in sizes])
    ranges = [_range(read, own, product, seed, width) for read, own, product in zip(reads, weights, products, strict=True)]
    bases = [(basis * own.idf[:, None]).astype(np.float32) for (basis, _), own in zip(ranges, weights, strict=True)]
    grams = _added(rows.mapInArrow(lambda it: _grams(it, bases, weights), _PART), [(b.shape[1], b.shape[1]) for b in bases])
    return [_model(read, df, own, basis, gram, scale, rank) for read, df, own, basis, gram, (_, scale) in zip(reads, dfs, weights, bases, grams, ranges, strict=True)]


_PART = "slice int, block int, lane int, part binary"


def _range(read: Items, weights: Weights, product: np.ndarray, seed: int, width: int) -> tuple[np.ndarray, float]:
    """An orthonormal basis of the range of the sketch, and how much the items weigh in it."""
    term, stride, first, _ = _item_strides(read)
    own = _product(term, stride, int(first[-1]), weights, _random(seed, weights.idf, width))
    scale = WEIGHT * max(1.0, np.linalg.norm(product) / max(np.linalg.norm(own), 1e-12))
    return np.linalg.qr(product + own * scale)[0], scale


def _model(read: Items, df: np.ndarray, weights: Weights, basis: np.ndarray, gram: np.ndarray, scale: float, rank: int) -> Model:
    """The leading directions, by the products of all projected passages; ``basis`` has the idf in it."""
    term, stride, first, owner = _item_strides(read)
    items = _summed(basis, weights, term, stride, int(first[-1]))
    _, directions = np.linalg.eigh(gram + scale * (items.T @ items))  # ascending
    leading = directions[:, ::-1][:, :rank].astype(np.float32)
    latent = items @ leading
    size = np.linalg.norm(latent, axis=1)
    anchors, lacking = _anchors(read, df, weights)
    keep = (size > 1e-6) & ~np.isin(owner, lacking)
    return Model(read, anchors, _frequent(read, lacking), weights, basis @ leading, latent[keep] / size[keep, None], size[keep], owner[keep])


def common_subsequence(masks: dict[int, int], size: int, sequence: list[int]) -> int:
    """The length of the longest common subsequence with the item that ``masks`` describe, a bit for each word."""
    full = (1 << size) - 1
    row = full
    for term in sequence:
        if mask := masks.get(term):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _holds(sequence: list[int], positions: list[int], run: list[int]) -> bool:
    """Whether the run of terms stands in the sequence, at adjacent positions."""
    n = len(run)
    return any(sequence[i : i + n] == run and positions[i + n - 1] - positions[i] == n - 1 for i in range(len(sequence) - n + 1))


def _share(item: np.ndarray, answer: np.ndarray, masks: dict[int, int], term: np.ndarray, position: np.ndarray, start: int, near: bool) -> float:
    """The share of the item found around the passage, to which its cosine may be ``near``; 0 if that isn't enough."""
    size = len(item)
    enough = PARAPHRASE if near and size >= LOOSE else SHARE
    least = min(enough, SHARE_WITH_ANSWER) * size
    reach = _reach(size)
    around, best, answered = position.searchsorted([start - size, start + 2 * STRIDE + reach]), 0, False
    sequence, places = term[around[0] : around[1]].tolist(), position[around[0] : around[1]]
    if size < SHORT:
        return float(_holds(sequence, places.tolist(), item.tolist()))
    if sum(map(masks.__contains__, sequence)) < least or common_subsequence(masks, size, sequence) < least:
        return 0.0
    for lo in range(start - size, start + 2 * STRIDE, max(1, size // 8)):
        a, b = places.searchsorted([lo, lo + reach])
        if b - a >= least and (found := common_subsequence(masks, size, sequence[a:b])) > best:
            best = found
    share = best / size
    if SHARE_WITH_ANSWER <= share < enough:
        answered = len(answer) < size and len(answer) >= 4 and _holds(sequence, places.tolist(), answer.tolist())
    return share if share >= enough or answered else 0.0


def _near(model: Model, term: np.ndarray, stride: np.ndarray, strides: int) -> Iterator[tuple[int, int]]:
    """(passage, item) wherever the cosine is high."""
    if not len(term) or not len(model.latent):
        return
    passages = _summed(model.basis, model.weights, term, stride, strides)
    size = np.linalg.norm(passages, axis=1)
    for lo in range(0, len(passages), 1 << 14):
        some = np.flatnonzero(size[lo : lo + (1 << 14)] > 1e-6) + lo
        near = (passages[some] / size[some, None]) @ model.latent.T
        hits = (near >= COSINE) & (near * size[some, None] >= PART * model.size)
        for row, column_no in zip(*np.nonzero(hits), strict=True):
            yield int(some[row]), int(model.owner[column_no])


def _places(frequent: Frequent, place: np.ndarray, term: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in grains, items) where an item has enough words in common with the words that its reach covers, in any order."""
    grain, n_terms = place // GRAIN, len(frequent.counts[0])
    cover = (frequent.reach - 2) // GRAIN + 2  # grains
    # a feature for each time that an item has a term: whether there are more than r of it
    features = [(r, np.flatnonzero((frequent.counts > r).any(axis=0))) for r in range(int(frequent.counts.max()))]
    matrix = np.concatenate([(frequent.counts > r)[:, own] for r, own in features], axis=1).T.astype(np.float32)
    total, widest = -(-length // GRAIN), int(cover.max())
    step = max(widest, _CELLS // n_terms)
    for lo in range(0, total, step):
        a, b = np.searchsorted(grain, [lo, lo + step + widest])
        counts = np.bincount((grain[a:b] - lo) * n_terms + term[a:b], minlength=(step + widest) * n_terms).reshape(-1, n_terms)
        summed = np.concatenate([np.zeros((1, n_terms), np.int32), np.cumsum(counts, axis=0, dtype=np.int32)])
        for width in np.unique(cover).tolist():
            inside = summed[width : width + step] - summed[:step]
            has = np.concatenate([inside[:, own] > r for r, own in features], axis=1).astype(np.float32)
            own = np.flatnonzero(cover == width)
            at, item = np.nonzero(has @ matrix[:, own] >= frequent.least[own])
            yield at + lo, own[item]


def _subsequences(frequent: Frequent, item: np.ndarray, start: np.ndarray, words_at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The common subsequence of each item and the words from each start to its reach, as bits of all pairs at once."""
    full = (U64(1) << (sizes - 1).astype(U64)) * U64(2) - U64(1)  # for 64 words, all bits
    row, reach = full.copy(), frequent.reach[item]
    for k in range(int(reach.max(initial=0))):
        hit = row & np.where(k < reach, frequent.masks[item, words_at[start + k]], U64(0))
        row = ((row + hit) | (row - hit)) & full
    return sizes - np.bitwise_count(row).astype(np.int64)


def _compared(model: Model, term: np.ndarray, position: np.ndarray, doc: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(document, item, share) of the frequent items."""
    frequent = model.frequent
    if frequent is None:
        return
    kept = np.flatnonzero(frequent.local[term] >= 0)
    term, position, doc = frequent.local[term[kept]], position[kept], doc[kept]
    gap = int(frequent.reach.max()) + GRAIN
    offset = np.concatenate([[0], np.cumsum(-(-(sizes + gap) // GRAIN) * GRAIN)])  # no place reaches into the next document
    place = position + offset[doc]
    words_at = np.full(int(offset[-1]) + 2 * gap, frequent.counts.shape[1])
    words_at[place] = term
    n_words = np.array([len(model.items.sequences[i]) for i in frequent.items.tolist()])
    best: dict[tuple[int, int], int] = {}
    for at, item in _places(frequent, place, term, int(offset[-1])):
        step = np.clip(n_words[item] // 8, 1, GRAIN)
        n = -(-GRAIN // step)
        start = np.repeat(at * GRAIN, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * np.repeat(step, n)
        item, owner = np.repeat(item, n), np.searchsorted(offset, start, "right") - 1
        inside = start < offset[owner] + sizes[owner]  # from behind a document one sees the next
        item, start, owner = item[inside], start[inside], owner[inside]
        for lo in range(0, len(item), 1 << 14):
            own, begin = item[lo : lo + (1 << 14)], start[lo : lo + (1 << 14)]
            size = n_words[own]
            found = np.zeros(len(own), np.int64)
            small = size <= _BITS
            found[small] = _subsequences(frequent, own[small], begin[small], words_at, size[small])
            for k in np.flatnonzero(~small).tolist():
                sequence = words_at[begin[k] : begin[k] + frequent.reach[own[k]]]
                masks: dict[int, int] = {}
                for i, t in enumerate(frequent.local[model.items.sequences[frequent.items[own[k]]]].tolist()):
                    masks[t] = masks.get(t, 0) | 1 << i
                found[k] = common_subsequence(masks, int(size[k]), sequence.tolist())
            for k in np.flatnonzero(found >= frequent.least[own]).tolist():
                key = (int(owner[lo + k]), int(own[k]))
                best[key] = max(best.get(key, 0), int(found[k]))
                if found[k] < SHARE * size[k] and best[key] == found[k] and _answered(model, frequent, int(own[k]), words_at[max(begin[k] - size[k], offset[key[0]]) : begin[k] + frequent.reach[own[k]] + size[k]]):
                    yield key[0], int(frequent.items[own[k]]), found[k] / size[k]
    for (d, row), found in best.items():
        if found >= SHARE * n_words[row]:
            yield d, int(frequent.items[row]), found / n_words[row]


def _answered(model: Model, frequent: Frequent, row: int, around: np.ndarray) -> bool:
    """Whether the item's answer stands among these words, word by word."""
    item = frequent.items[row]
    answer = frequent.local[model.items.answers[item]]
    if not 4 <= len(answer) < len(model.items.sequences[item]) or len(around) < len(answer):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(around, len(answer)) == answer).all(axis=1).any())


def _search(hashes: np.ndarray, offsets: np.ndarray, model: Model) -> list[tuple[int, float] | None]:
    """Of each text the item found in it with the greatest share, if any."""
    items = model.items
    term, position, doc, sizes = _restricted(hashes, offsets, items.vocabulary)
    stride, first = _strides(position, doc, sizes)
    out: list[tuple[int, float] | None] = [None] * len(sizes)
    masks: dict[int, dict[int, int]] = {}
    seen = set()
    cut = np.searchsorted(doc, np.arange(len(sizes) + 1))
    near = ((at, item, True) for at, item in _near(model, term, stride, int(first[-1])))
    anchored = ((at, item, False) for at, item in _anchored(model.anchors, term, position, doc, sizes, first))
    for at, item, is_near in chain(near, anchored):
        if (at, item) in seen:
            continue
        seen.add((at, item))
        d = int(np.searchsorted(first, at, "right")) - 1
        if out[d] is not None and (-1.0, items.ids[item]) >= (-out[d][1], out[d][0]):  # can't be better
            continue
        own = items.sequences[item]
        if item not in masks:
            masks[item] = {}
            for i, t in enumerate(own.tolist()):
                masks[item][t] = masks[item].get(t, 0) | 1 << i
        a, b = cut[d], cut[d + 1]
        share = _share(own, items.answers[item], masks[item], term[a:b], position[a:b], (at - int(first[d])) * STRIDE, is_near)
        if share and _better((items.ids[item], share), out[d]):
            out[d] = (items.ids[item], share)
    for d, item, share in _compared(model, term, position, doc, sizes):
        if _better((items.ids[item], share), out[d]):
            out[d] = (items.ids[item], share)
    return out


def _better(found: tuple[int, float], best: tuple[int, float] | None) -> bool:
    return best is None or (-found[1], found[0]) < (-best[1], best[0])


def _flags(batches: Iterator[pa.RecordBatch], at: int, models: list[Model], dropped: bool) -> Iterator[pa.RecordBatch]:
    """Rows end in an item and its share, which a better one replaces; the texts may be ``dropped``."""
    for batch in words.sliced(batches, at):
        best = [(i, s) if i is not None else None for i, s in zip(batch.column(-2).to_pylist(), batch.column(-1).to_pylist(), strict=True)]
        hashes, where = words.tokens(batch.column(at), lower=True)
        for model in models:
            for i, found in enumerate(_search(hashes, where, model)):
                if found and _better(found, best[i]):
                    best[i] = found
        columns = [c for i, c in enumerate(batch.columns[:-2]) if not (dropped and i == at)]
        columns += [pa.array([x[0] if x else None for x in best], pa.int64()), pa.array([x[1] if x else 0.0 for x in best], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])


def flag(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``contaminated``, and ``item_id`` and ``share`` of the item found."""
    names = [c for c in docs.columns if c not in ("contaminated", "item_id", "share")]
    at = names.index(text)
    out = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("share"))
    slices = _slices(benchmark, item_id, item_text)
    some = list(islice(slices, SLICES))
    while some:
        models, later = fit(docs, some, text), list(islice(slices, SLICES))
        dropped = not keep_text and not later
        schema = T.StructType([f for i, f in enumerate(out.schema) if not (dropped and i == at)])
        out = out.mapInArrow(partial(_flags, at=at, models=models, dropped=dropped), schema)
        out, some = scratch.save(out) if later else out, later
    kept = [i for i in range(len(names)) if keep_text or i != at]
    return out.select(*(F.col(f"c{i}").alias(names[i]) for i in kept), "item_id", "share", F.col("item_id").isNotNull().alias("contaminated"))
