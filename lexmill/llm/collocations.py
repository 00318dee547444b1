"""Phrase collocation mining (operator 11): sketch bounds, automata over shards, exact scores.

Texts are lower-cased (A-Z), split into pieces and these into words; a phrase is two to
``longest`` words in a row of one piece.  Everything is counted by language.

1. A sketch counts words and pairs, a second one longer phrases all of whose pairs reached the
   bound in the first.  A counter is the sum over all phrases that fall on it, so it never
   falls short of one of them: a phrase whose counter is too low is no candidate.  What the
   tasks send are sorted runs of counters; what reaches the driver is a bit a counter.
2. Each shard of texts of one language compiles the candidates it holds into an Aho-Corasick
   automaton, whose entries are guarded by delimiters on both sides, and counts all matches,
   overlapping ones too.  Sums over the shards are the phrases' exact frequencies, and the
   least frequency is applied to these.  An automaton is bounded by its shard.
3. Cuts of a phrase are looked up among the frequencies (each part is at least as frequent
   as the phrase, so it was counted), and scores are computed in decimals.

The width of the sketch decides how many candidates are scanned for in vain, never the result.

Defined results: a null or empty text has no words; a null language is ``und``; texts of any
length are read whole (cut where pieces end); repeated rows count each; ties are ordered by phrase; an empty table
gives no rows.  Only the two columns named are read; others may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import blobs, scratch, words

#: Counters of a sketch; the driver holds a bit of each.
WIDTH = 1 << 27
#: Counters of a range, which one task sums.
_RANGE = 1 << 20
#: Phrases that a task gathers before it sends their counters.
_RUN = 1 << 21
#: Bytes of text that share an automaton, and phrases that a task holds before it sends them.
SHARD, _HELD = 1 << 22, 200_000
#: Parts of a language, by a hash of the phrase, in which frequencies are sent and summed: each is one task's at most.
LANES = 4096
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True
U64 = np.uint64


class _Words:
    """The words of a column of texts: bytes, bounds, the text and the piece of each, and hashes that differ by language."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        raw, offsets = words.text_bytes(texts)
        self.raw = words.LOWER[raw]
        self.starts, self.ends = words.bounds(self.raw, offsets, _OUTSIDE)
        self.text = np.searchsorted(offsets, self.starts, "right") - 1
        broken = np.cumsum(_BREAK[self.raw])
        # words of one text and piece
        self.piece = broken[self.starts] + self.text if len(self.starts) else np.zeros(0, np.int64)
        self.hashes = words.hash_words(self.raw, self.starts, self.ends)
        names, at = words.text_bytes(langs)
        self.lang = words.hash_words(names, at[:-1], at[1:])[self.text]

    def pairs(self) -> np.ndarray:
        """Whether a word and the next one are of one piece."""
        out = np.zeros(len(self.starts), bool)
        out[:-1] = self.piece[1:] == self.piece[:-1]
        return out

    def counters(self, at: np.ndarray, length: int, width: int) -> np.ndarray:
        """The counter of each phrase of ``length`` words that starts at the words ``at``."""
        own = words.beside(self.hashes, at, length) ^ self.lang[at]
        return (words.mix(own + U64(length)) % U64(width)).astype(np.uint32)


def _heavy(bits: np.ndarray, counters: np.ndarray) -> np.ndarray:
    return (bits[counters >> np.uint32(3)] >> (np.uint8(7) - (counters & np.uint32(7)).astype(np.uint8))) & np.uint8(1) == 1


def _starts(own: _Words, longest: int, first: np.ndarray, second: np.ndarray | None, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length from 2 on the words at which a phrase starts whose parts, and with ``second`` itself, reached the bound."""
    pair = np.flatnonzero(own.pairs())
    alive = np.zeros(len(own.starts) + 1, bool)
    alive[pair[_heavy(first, own.counters(pair, 2, width))]] = True
    yield 2, np.flatnonzero(alive)
    for length in range(3, longest + 1):
        alive[:-1] &= alive[1:]  # both phrases with a word less
        at = np.flatnonzero(alive)
        if second is not None:
            at = at[_heavy(second, own.counters(at, length, width))]
            alive[:] = False
            alive[at] = True
        yield length, at


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of texts and languages; a long text is cut where pieces end, so that arrays over words are bounded but for a long piece."""
    for batch in words.sliced(batches, 0, words.STEP):
        raw, _ = words.text_bytes(batch.column(0))
        if batch.num_rows > 1 or len(raw) <= words.STEP:
            yield batch
            continue
        ends = np.flatnonzero(_BREAK[raw]) + 1
        lo = 0
        while lo < len(raw):
            k = int(np.searchsorted(ends, lo + words.STEP))
            hi = int(ends[k]) if k < len(ends) else len(raw)
            yield pa.RecordBatch.from_arrays([pa.array([raw[lo:hi].tobytes().decode()]), batch.column(1)], names=["text", "lang"])
            lo = hi


def _sent(found: list[np.ndarray]) -> pa.RecordBatch:
    """A run of counters, as a row for each range that has some."""
    counters, counts = np.unique(np.concatenate(found), return_counts=True)
    part = counters // np.uint32(_RANGE)
    cuts = [*blobs.runs(part).tolist(), len(part)]
    rows = [(int(part[a]), b - a, blobs.pack(counters[a:b]), blobs.pack_plain(counts[a:b].astype(np.uint32))) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["part", "n", "counters", "counts"])


def _counted(batches: Iterator[pa.RecordBatch], longest: int, first: np.ndarray | None, width: int) -> Iterator[pa.RecordBatch]:
    """The counters of words and pairs or, where these are known, of the longer phrases."""
    found: list[np.ndarray] = []
    for batch in _texts(batches):
        own = _Words(batch.column(0), batch.column(1))
        if first is None:
            found += [own.counters(np.arange(len(own.starts)), 1, width), own.counters(np.flatnonzero(own.pairs()), 2, width)]
        else:
            found += [own.counters(at, length, width) for length, at in _starts(own, longest, first, None, width) if length > 2]
        if sum(map(len, found)) >= _RUN:
            yield _sent(found)
            found = []
    if sum(map(len, found)):
        yield _sent(found)


def _summed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Bits of the counters that reach the bound; rows come by range."""
    part, total = None, np.zeros(_RANGE, np.int64)
    bits = lambda: pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blobs.pack_bits(total >= least)], pa.binary())], names=["part", "bits"])
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if part is not None:
                    yield bits()
                part, total = row["part"], np.zeros(_RANGE, np.int64)
            at = blobs.unpack(row["counters"], row["n"], np.uint32) - np.uint32(part * _RANGE)
            total[at] += blobs.unpack_plain(row["counts"], row["n"], np.uint32)
    if part is not None:
        yield bits()


def sketch(texts: DataFrame, least: int, longest: int, first: np.ndarray | None, width: int) -> np.ndarray:
    """A bit a counter: whether it reaches ``least`` over all texts."""
    sent = texts.mapInArrow(lambda it: _counted(it, longest, first, width), "part int, n int, counters binary, counts binary")
    summed = sent.repartition("part").sortWithinPartitions("part").mapInArrow(lambda it: _summed(it, least), "part int, bits binary")
    out = np.zeros(-(-width // _RANGE) * _RANGE // 8, np.uint8)
    for r in summed.collect():  # a row a range
        out[r["part"] * (_RANGE // 8) : (r["part"] + 1) * (_RANGE // 8)] = np.packbits(blobs.unpack_bits(bytes(r["bits"]), _RANGE))
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language, together of about the size of a shard."""
    held, size = [], 0
    for batch in _texts(batches):
        held.append(batch)
        size += int(words.text_bytes(batch.column(0))[1][-1])
        if size >= SHARD:
            yield from _by_lang(held)
            held, size = [], 0
    yield from _by_lang(held)


def _by_lang(held: list[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        for lang in pc.unique(table.column(1)).to_pylist():
            yield lang, table.filter(pc.equal(table.column(1), lang)).column(0).combine_chunks()


def _guarded(own: _Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space on both sides and a line feed between pieces, and where each word starts."""
    size = own.ends - own.starts
    opens = np.ones(len(size), np.int64)
    opens[1:] = own.piece[1:] != own.piece[:-1]
    at = np.cumsum(size + 1 + 2 * opens) - size - 1
    out = np.full(int(at[-1] + size[-1] + 1), 0x20, np.uint8)
    out[at[opens == 1] - 2] = 0x0A
    index = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at, size) + index] = own.raw[np.repeat(own.starts, size) + index]
    return out, at


def _counts(texts: pa.Array, lang: str, longest: int, first: np.ndarray, second: np.ndarray, width: int) -> Iterator[tuple[str, int]]:
    """A shard's frequencies of its words and candidates; the empty phrase stands for all words."""
    own = _Words(texts, pa.array([lang] * len(texts), pa.string()))
    if not len(own.starts):
        return
    size = own.ends - own.starts
    text, at = _guarded(own)
    data = text.tobytes()
    code = np.unique(words.word_codes(own.raw, own.starts, own.ends), return_inverse=True)[1]
    yield "", len(code)
    _, model, counts = np.unique(code, return_index=True, return_counts=True)
    common = np.flatnonzero(_heavy(first, own.counters(model, 1, width)))
    yield from ((data[at[i] : at[i] + size[i]].decode(), n) for i, n in zip(model[common].tolist(), counts[common].tolist(), strict=True))
    # phrases by number, each of the number of the phrase with a word less and its last word
    number, n_words, entries = code.astype(np.int64), int(code.max()) + 1, []
    for length, starts in _starts(own, longest, first, second, width):
        _, model, inverse = np.unique(number[starts] * n_words + code[starts + length - 1], return_index=True, return_inverse=True)
        number = np.zeros(len(code), np.int64)
        number[starts] = inverse
        ends = starts[model] + length - 1
        entries += zip(at[starts[model]].tolist(), (at[ends] + size[ends]).tolist(), strict=True)
    if entries:
        automaton = ahocorasick.Automaton()
        for i, (a, b) in enumerate(entries):
            automaton.add_word(data[a - 1 : b + 1].decode(), i)
        automaton.make_automaton()
        matches = np.fromiter((i for _, i in automaton.iter(data.decode())), np.int64)
        found = np.bincount(matches, minlength=len(entries)).tolist()
        yield from ((data[a:b].decode(), n) for (a, b), n in zip(entries, found, strict=True))


def _scanned(batches: Iterator[pa.RecordBatch], longest: int, first: np.ndarray, second: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """The frequencies in a task's shards, summed up and sent by lanes of a language."""
    total: dict[str, dict[str, int]] = {}
    for lang, texts in _shards(batches):
        own = total.setdefault(lang, {})
        for phrase, n in _counts(texts, lang, longest, first, second, width):
            own[phrase] = own.get(phrase, 0) + n
        if sum(map(len, total.values())) >= _HELD:
            yield from _by_lane(total)
            total = {}
    yield from _by_lane(total)


def _by_lane(total: dict[str, dict[str, int]]) -> Iterator[pa.RecordBatch]:
    for lang, own in total.items():
        lanes: dict[int, tuple[list[str], list[int]]] = {}
        for phrase, n in own.items():
            phrases, counts = lanes.setdefault(zlib.crc32(phrase.encode()) % LANES, ([], []))
            phrases.append(phrase)
            counts.append(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(lanes), pa.string()), pa.array(list(lanes), pa.int32()), *(pa.array([x[i] for x in lanes.values()], kind) for i, kind in enumerate((pa.list_(pa.string()), pa.list_(pa.int64()))))], names=["lang", "lane", "phrases", "counts"])


def _totals(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Sums of a lane's frequencies, of those that reach the least one; rows come by lane."""
    at, total = None, {}

    def kept() -> pa.RecordBatch:
        found = [(phrase, n) for phrase, n in total.items() if n >= least or not phrase]
        return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(found), pa.string()), pa.array([x for x, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["lang", "phrase", "n"])

    for batch in batches:
        for lang, lane, phrases, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (lang, lane) != at:
                if at:
                    yield kept()
                at, total = (lang, lane), {}
            for phrase, n in zip(phrases, counts, strict=True):
                total[phrase] = total.get(phrase, 0) + n
    if at:
        yield kept()


def frequencies(docs: DataFrame, least: int, longest: int, text: str, lang: str, width: int) -> DataFrame:
    """Language, phrase and frequency of all words and phrases of at least ``least`` occurrences; the empty phrase has all words'."""
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang")).where("text is not null")
    first = sketch(texts, least, longest, None, width)
    second = sketch(texts, least, longest, first, width)
    scanned = texts.mapInArrow(lambda it: _scanned(it, longest, first, second, width), "lang string, lane int, phrases array<string>, counts array<long>")
    by_lane = scanned.repartition("lang", "lane").sortWithinPartitions("lang", "lane")
    return by_lane.mapInArrow(lambda it: _totals(it, least), "lang string, phrase string, n long")


def _exact(*factors: Column) -> Column:
    """The product in decimals of 38 digits."""
    out = factors[0].cast("decimal(38,0)")
    for f in factors[1:]:
        out = (out * f.cast("decimal(38,0)")).cast("decimal(38,0)")
    return out


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, text: str = "text", lang: str = "lang", width: int = WIDTH) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is ``floor(1000 a n / (l r))`` at its lowest-scoring cut; a phrase whose
    words lie inside a longer one of the same frequency is dropped.
    """
    counted = scratch.save(frequencies(docs, least, longest, text, lang, width))
    totals = counted.where("phrase = ''").select("lang", F.col("n").alias("total"))
    single = counted.where("phrase != ''")
    long = single.where(F.contains("phrase", F.lit(" "))).withColumnRenamed("n", "a")
    size = F.size(F.split("phrase", " "))
    cuts = long.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    left = F.expr("substring_index(phrase, ' ', cut)")
    right = F.expr("substring_index(phrase, ' ', cut - size(split(phrase, ' ')))")
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("part")), F.struct(F.lit(1).alias("side"), right.alias("part")))).alias("of")
    parts = cuts.select("lang", "phrase", "a", "cut", sides).select("lang", "phrase", "a", "cut", "of.*")
    looked_up = parts.join(single.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")), ["lang", "part"])
    # a longer phrase as frequent as one inside is, has one with a single word more between them
    inside = long.where(size > 2).select("lang", F.expr("explode(array(substring_index(phrase, ' ', size(split(phrase, ' ')) - 1), substring_index(phrase, ' ', 1 - size(split(phrase, ' ')))))").alias("phrase"), F.col("a").alias("longer"))
    f = [[F.max(F.when((F.col("cut") == k) & (F.col("side") == s), F.col("f"))).alias(f"f{s}_{k}") for s in (0, 1)] for k in range(1, longest)]
    gathered = looked_up.unionByName(inside, allowMissingColumns=True).groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("longer").alias("longer"), *(c for pair in f for c in pair))
    kept = gathered.where("a is not null and (longer is null or longer < a)").join(totals, "lang")

    def scored(k: int) -> Column:
        score = F.call_function("div", _exact(F.lit(1000), F.col("a"), F.col("total")), _exact(F.col(f"f0_{k}"), F.col(f"f1_{k}")))
        return F.when(F.col(f"f0_{k}").isNotNull(), F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"f0_{k}").alias("l"), F.col(f"f1_{k}").alias("r")))

    best = F.array_min(F.array(*(scored(k) for k in range(1, longest))))
    rows = kept.select("lang", "phrase", "a", F.col("total").alias("n"), best.alias("cut")).select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    return first_by_lang(rows, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def first_by_lang(rows: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their ranks, by lanes of a language and then by fewer, so that no task sorts a whole language."""
    order = "order by score desc, a desc, phrase"
    n = scratch.partitions(rows.sparkSession)
    for lanes in (n, isqrt(n)):
        rows = rows.withColumn("rank", F.expr(f"row_number() over (partition by lang, pmod(xxhash64(phrase), {lanes}) {order})")).where(F.col("rank") <= top)
    return rows.withColumn("rank", F.expr(f"row_number() over (partition by lang {order})")).where(F.col("rank") <= top)
