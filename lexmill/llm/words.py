"""Vectorised words and word hashes over Arrow text columns.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; that is ``[^\\x20\\x09-\\x0D]+`` over code points, as UTF-8 has
these bytes only as themselves.

A word's hash adds up its eight-byte parts, each mixed with a key of its place, so no
pattern of letters makes two words alike.  A window's hash is a polynomial over Z/2^64 of
its words' hashes, computed from prefix sums.  Where 64 bits are too few, a second, independent
hash goes beside the first (``tokens`` with ``second``, ``beside``); ``shingles`` with
``exact`` tells shingles apart by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C17  # odd, 3 mod 4: base - 1 has one factor 2 only
_OTHER_BASE = 0xD1B54A32D192ED03
STEP = 1 << 21  # bytes hashed at a time, so that the arrays stay in the cache
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all bits."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Parts of a word that are hashed for all words at once.
_FEW = 8
_KEYS = mix(np.arange(1, 2 * _FEW + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_OTHER_KEYS = mix(_KEYS ^ U64(0xD6E8FEB86659FD93))
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse, at least n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, STEP + (1 << 16))
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(1, dtype=U64)
            while len(out) < size:
                out = np.concatenate([out, out * U64(pow(base, len(out), 1 << 64))])
            _powers[name] = out[:size]
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and the n + 1 offsets; nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def sliced(batches: Iterator[pa.RecordBatch], at: int, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of column ``at`` have about ``size`` bytes in each; a longer text is alone.

    Arrays over all words of a batch then have a bounded size, however many rows Arrow batches have.
    """
    for batch in batches:
        _, offsets = text_bytes(batch.column(at))
        for lo, hi in pieces(offsets, size):
            yield batch.slice(lo, hi - lo)


def bounds(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word; no word reaches over the end of a text.  ``space`` tells for each byte whether it parts words."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~space[raw]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    start[first] = word[first]
    end[last] = word[last]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def pieces(offsets: np.ndarray, step: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``step`` bytes; a longer text is alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + step, "right")) - 1)
        yield lo, hi
        lo = hi


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray = _KEYS) -> np.ndarray:
    """A 64-bit hash of each word's bytes; ``keys`` are two per place of a part."""
    if not len(starts):
        return np.zeros(0, U64)
    size = ends - starts
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    parts = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = _part(parts, starts, np.minimum(size, 8), keys[0], keys[1])
    for place in range(1, _FEW):
        at = np.flatnonzero(size > 8 * place)
        out[at] += _part(parts, starts[at] + 8 * place, np.minimum(size[at] - 8 * place, 8), keys[2 * place], keys[2 * place + 1])
    for word in np.flatnonzero(size > 8 * _FEW).tolist():  # a long one, in blocks of parts
        for lo in range(_FEW, -(-int(size[word]) // 8), STEP >> 3):
            place = np.arange(lo, min(lo + (STEP >> 3), -(-int(size[word]) // 8)))
            own = mix(place.astype(U64)[:, None] + keys[:2])
            out[word : word + 1] += _part(parts, starts[word] + 8 * place, np.minimum(size[word] - 8 * place, 8), own[:, 0], own[:, 1]).sum(dtype=U64)
    return mix(out + size.astype(U64))


def _part(parts: np.ndarray, at: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    value = np.ascontiguousarray(parts[at]).view("<u8")[:, 0] & _MASK[size]
    return mix((value ^ low) + high)


def tokens(column: pa.Array | pa.ChunkedArray, lower: bool = False, second: bool = False) -> tuple[np.ndarray, ...]:
    """The word hashes of all texts, one after another, and the n + 1 word offsets.

    With ``lower``, A-Z are lower-cased first; with ``second``, independent hashes come third.
    """
    raw, offsets = text_bytes(column)
    parts, others, counts = [np.zeros(0, U64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for lo, hi in pieces(offsets, STEP):
        piece = raw[offsets[lo] : offsets[hi]]
        piece = LOWER[piece] if lower else piece
        at = offsets[lo : hi + 1] - offsets[lo]
        starts, ends = bounds(piece, at)
        parts.append(hash_words(piece, starts, ends))
        if second:
            others.append(hash_words(piece, starts, ends, _OTHER_KEYS))
        counts.append(np.diff(np.searchsorted(starts, at)))
    where = np.zeros(len(offsets), np.int64)
    np.cumsum(np.concatenate(counts), out=where[1:])
    out = np.concatenate(parts), where
    return (*out, np.concatenate(others)) if second else out


def beside(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of ``length`` words at the given starts."""
    out = np.empty(len(starts), U64)
    power = [U64(pow(_OTHER_BASE, k, 1 << 64)) for k in range(length)]
    for lo in range(0, len(starts), STEP >> 3):
        at = starts[lo : lo + (STEP >> 3)]
        total = np.zeros(len(at), U64)
        for k in range(length):
            total += hashes[at + k] * power[k]
        out[lo : lo + len(at)] = mix(total)
    return out


def codes(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> np.ndarray:
    """A number for each word of all texts, equal for equal words and for no others."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw] if lower else raw
    return word_codes(raw, *bounds(raw, offsets))


def word_codes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words and for no others."""
    if not len(starts):
        return np.zeros(0, U64)
    size = ends - starts
    parts = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, np.uint8)]), 8)
    # a short word is its own number; others are numbered, with a first byte that UTF-8 doesn't have
    out = np.ascontiguousarray(parts[starts]).view("<u8")[:, 0] & _MASK[np.minimum(size, 8)]
    long = np.flatnonzero((size > 8) | (raw[ends - 1] == 0))
    if len(long):
        at = np.concatenate([[0], np.cumsum(size[long])])
        data = raw[np.repeat(starts[long] - at[:-1], size[long]) + np.arange(at[-1])]
        array = pa.Array.from_buffers(pa.large_binary(), len(long), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        out[long] = array.dictionary_encode().indices.to_numpy().astype(U64) | U64(0xFF << 56)
    return out


def windows(hashes: np.ndarray, where: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``length`` words that lie within one text, and where they start."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    out = np.empty(n, U64)
    for lo in range(0, n, STEP >> 2):
        hi = min(n, lo + (STEP >> 2))
        part = hashes[lo : hi + length - 1]
        up, down = _power(len(part) + 1)
        total = np.empty(len(part) + 1, U64)
        total[0] = 0
        np.cumsum(part * up[: len(part)], out=total[1:])
        out[lo:hi] = (total[length:] - total[:-length]) * down[: hi - lo]
    inside = np.ones(len(hashes) + 1, bool)
    for back in range(1, length):
        late = where[1:] - back
        inside[late[late >= where[:-1]]] = False
    starts = np.flatnonzero(inside[:n])
    return mix(out[starts] + U64(length)), starts


def _told_apart(found: np.ndarray, first: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Numbers instead of the hashes ``found`` of the runs of words that start at ``first``: equal for equal runs of ``code`` only."""
    run, distinct = pd.factorize(found)
    model = np.empty(len(distinct), np.int64)  # of each hash the first place it is found at
    model[run[::-1]] = np.arange(len(found))[::-1]
    model = model[run]
    alike = size == size[model]
    for k in range(int(size.max(initial=0))):
        alike &= (size <= k) | (code[np.minimum(first + k, len(code) - 1)] == code[np.minimum(first[model] + k, len(code) - 1)])
    if alike.all():  # hashes tell the same as words
        return found
    own: dict[tuple, int] = {}
    return np.array([own.setdefault(tuple(code[a : a + n].tolist()), len(own)) for a, n in zip(first.tolist(), size.tolist(), strict=True)], U64)


def shingles(column: pa.Array | pa.ChunkedArray, length: int, lower: bool = True, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, and the n + 1 offsets.

    A text with fewer words than ``length`` has its whole sequence as its only shingle; a
    text without words has none.  With ``exact``, shingles of different words have different
    numbers within the column, whatever their hashes.
    """
    hashes, where = tokens(column, lower)
    found, starts = windows(hashes, where, length)
    sizes = np.diff(where)
    text = np.searchsorted(where, starts, "right") - 1
    short = np.flatnonzero((sizes > 0) & (sizes < length))
    if len(short):
        own = np.empty(len(short), U64)
        for size in np.unique(sizes[short]):
            of = np.flatnonzero(sizes[short] == size)
            block = hashes[where[short[of]][:, None] + np.arange(size)]
            up, _ = _power(int(size))
            own[of] = mix((block * up[:size]).sum(axis=1, dtype=U64) + U64(size))
        found, text = np.concatenate([found, own]), np.concatenate([text, short])
    if exact and len(found):
        first = np.concatenate([starts, where[short]])
        found = _told_apart(found, first, np.concatenate([np.full(len(starts), length), sizes[short]]), codes(column, lower))
    if len(short):
        order = np.argsort(text, kind="stable")
        found, text = found[order], text[order]
    where = np.searchsorted(text, np.arange(len(sizes) + 1))
    for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True):
        found[a:b].sort()
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    found, text = found[first], text[first]
    return found, np.searchsorted(text, np.arange(len(sizes) + 1))
