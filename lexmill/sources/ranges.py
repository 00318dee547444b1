"""Large files read by many tasks: numbered lines, and the objects of one JSON array.

Lines come from Spark's own splits of a file; a line's number is its place in its split and the
sum of the lines of the splits before.

A JSON array needn't have lines.  It is cut into byte ranges wherever they fall.  A range is
read once as if it began inside a string or outside, and after a backslash or not: what each
of the four beginnings leads to (whether the range ends in a string, after a backslash, and
how much deeper or higher) is all that is needed to tell, file by file, how every range
really begins.  Then each range gives the objects that begin in it and reads on until the last
one ends.  Ranges are read by URI (``pyarrow.fs``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a range.
SIZE = 1 << 25
#: Bytes that are read at once behind a range for its last object: at first, and at most.
_NEAR, _AHEAD = 1 << 12, 1 << 20
_QUOTE, _BACKSLASH = 0x22, 0x5C
_DEEPER = np.zeros(256, np.int8)
_DEEPER[[ord("["), ord("{")]] = 1
_DEEPER[[ord("]"), ord("}")]] = -1
_RANGES = "path string, k long, start long, stop long"


# --- lines -------------------------------------------------------------------------------


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files; lines end in line feeds and count from 1 in each file."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), "value")
    splits = rows.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.expr("coalesce(sum(n) over (partition by file order by split rows between unbounded preceding and 1 preceding), 0)")
    numbered = rows.join(splits.select("file", "split", "first", before.alias("before")), ["file", "split"])
    return numbered.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "value")


# --- ranges ------------------------------------------------------------------------------


def ranges(spark: SparkSession, path: str, size: int = SIZE) -> tuple[DataFrame, int]:
    """(path, k, start, stop) of the files' byte ranges, and the tasks that they are dealt to: each has ranges of ``SIZE`` bytes or so together, of fewer if there are cores to spare."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    n, length = files.agg(F.sum(F.ceil(F.col("length") / size)), F.sum("length")).first()
    tasks = max(1, min(int(n or 0), max(-(-int(length or 0) // SIZE), 3 * spark.sparkContext.defaultParallelism)))
    cut = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / size) - 1)).alias("k"))
    out = cut.select("path", F.col("k").cast("long").alias("k"), (F.col("k") * size).cast("long").alias("start"), F.least(F.col("k") * size + size, F.col("length")).cast("long").alias("stop"))
    return out.repartition(tasks, "path", "k"), tasks


def _bytes(path: str, start: int, stop: int) -> np.ndarray:
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    with system.open_input_file(at) as f:
        return np.frombuffer(f.read_at(stop - start, start), np.uint8)


def _quotes(raw: np.ndarray) -> tuple[np.ndarray, int, int]:
    """The quotes that no backslash escapes, the number of backslashes that the range begins with, and of those that it ends with."""
    slash = np.flatnonzero(raw == _BACKSLASH)
    quote = np.flatnonzero(raw == _QUOTE)
    if not len(slash):
        return quote, 0, 0
    first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)  # of each run
    last = slash[np.append(first[1:], len(slash)) - 1]
    length = last - slash[first] + 1
    run = np.searchsorted(last, quote - 1)
    after = (run < len(last)) & (last[np.minimum(run, len(last) - 1)] == quote - 1)
    escaped = after & (length[np.minimum(run, len(last) - 1)] % 2 == 1)
    return quote[~escaped], int(length[0]) if slash[0] == 0 else 0, int(length[-1]) if last[-1] == len(raw) - 1 else 0


def _starting(raw: np.ndarray, escape: int, known: tuple[np.ndarray, int, int] | None = None) -> tuple[np.ndarray, int]:
    """The quotes that no backslash escapes if one stands before the range (``escape``), and whether one is open at its end; ``known``: what ``_quotes`` says."""
    quotes, leading, trailing = known or _quotes(raw)
    whole = trailing == len(raw)
    if escape and leading < len(raw) and raw[leading] == _QUOTE:
        # the run before the first other byte is longer by one
        quotes = np.setxor1d(quotes, [leading])
    return quotes, (trailing + (escape if whole else 0)) % 2


def _outside(raw: np.ndarray, quotes: np.ndarray, string: int) -> tuple[np.ndarray, np.ndarray]:
    """Where brackets stand outside strings, and by how much each goes deeper."""
    at = np.flatnonzero(_DEEPER[raw])
    at = at[(np.searchsorted(quotes, at) + string) % 2 == 0]
    return at, _DEEPER[raw[at]].astype(np.int64)


def transitions(raw: np.ndarray) -> list[tuple[int, int, int]]:
    """For each beginning, 2 x string + escape: the same of the end, and the change of depth."""
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * 4
    known, at = _quotes(raw), np.flatnonzero(_DEEPER[raw])
    step = _DEEPER[raw[at]].astype(np.int64)
    for escape in (0, 1):
        quotes, open_escape = _starting(raw, escape, known)
        odd = np.searchsorted(quotes, at) % 2
        for string in (0, 1):
            out[2 * string + escape] = ((string + len(quotes)) % 2, open_escape, int(step[odd == string].sum()))
    return out


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            raw = _bytes(row["path"], row["start"], row["stop"])
            said = transitions(raw)
            filled = raw[~np.isin(raw, list(b" \t\r\n"))]
            ends = bytes(filled[:1]).decode("latin-1"), bytes(filled[-1:]).decode("latin-1")
            yield pa.RecordBatch.from_pylist([row | {"to": [2 * s + e for s, e, _ in said], "deeper": [d for *_, d in said], "first": ends[0], "last": ends[1]}], _SUMMARY)


_SUMMARY = pa.schema([("path", pa.string()), ("k", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("to", pa.list_(pa.int32())), ("deeper", pa.list_(pa.int64())), ("first", pa.string()), ("last", pa.string())])


def _folded(table: pa.Table) -> pa.Table:
    """How each range of a file begins; none if the file isn't a whole array."""
    state, depth, out = 0, 0, []
    rows = table.sort_by("k").to_pylist()
    for row in rows:
        out.append({c: row[c] for c in ("path", "k", "start", "stop")} | {"state": state, "depth": depth, "size": rows[-1]["stop"]})
        depth += row["deeper"][state]
        state = row["to"][state]
    ends = [x["first"] for x in rows if x["first"]][:1] + [x["last"] for x in rows if x["last"]][-1:]
    whole = ends == ["[", "]"] and state == 0 and depth == 0
    return pa.Table.from_pylist(out if whole else [], _BEGUN)


_BEGUN = pa.schema([("path", pa.string()), ("k", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("state", pa.int32()), ("depth", pa.int64()), ("size", pa.int64())])


def _objects(batches: Iterator[pa.RecordBatch], ahead: int) -> Iterator[pa.RecordBatch]:
    """(file, at, text) of the objects right below the array that begin in a range."""
    for batch in batches:
        for row in batch.to_pylist():
            raw = _bytes(row["path"], row["start"], row["stop"])
            quotes, escape = _starting(raw, row["state"] % 2)
            at, step = _outside(raw, quotes, row["state"] // 2)
            string = (row["state"] // 2 + len(quotes)) % 2
            depth = row["depth"] + np.cumsum(step)
            begin = at[(raw[at] == ord("{")) & (depth == 2)]
            end = at[(raw[at] == ord("}")) & (depth == 1)] + 1
            end = end[end > begin[0]] if len(begin) else end[:0]
            texts = [raw[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=False)]
            if len(end) < len(begin):  # the last one ends behind the range
                texts.append(b"".join(_rest(row, raw[begin[-1] :], string, escape, int(depth[-1]), ahead)))
            for lo in range(0, len(texts), 1 << 12):
                part = texts[lo : lo + (1 << 12)]
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(part)), pa.array(begin[lo : lo + len(part)] + row["start"]), pa.array([x.decode() for x in part], pa.string())], names=["file", "at", "text"])


def _rest(row: dict, begun: np.ndarray, string: int, escape: int, depth: int, ahead: int) -> Iterator[bytes]:
    yield begun.tobytes()
    start, length = row["stop"], min(ahead, _NEAR)  # most end soon
    while start < row["size"]:
        raw = _bytes(row["path"], start, min(start + length, row["size"]))
        length = min(2 * length, ahead)
        quotes, escape = _starting(raw, escape)
        at, step = _outside(raw, quotes, string)
        low = np.flatnonzero(depth + np.cumsum(step) == 1)
        if len(low):
            yield raw[: at[low[0]] + 1].tobytes()
            return
        yield raw.tobytes()
        string, depth, start = (string + len(quotes)) % 2, depth + int(step.sum()), start + len(raw)


def array_objects(spark: SparkSession, path: str, size: int = SIZE, ahead: int = _AHEAD) -> DataFrame:
    """(file, at, text) of the objects of JSON arrays, with the byte at which each begins; a file that isn't a whole array has none."""
    cut, tasks = ranges(spark, path, size)
    said = cut.mapInArrow(_summaries, f"{_RANGES}, to array<int>, deeper array<long>, first string, last string")
    begun = said.groupBy("path").applyInArrow(_folded, f"{_RANGES}, state int, depth long, size long")
    return begun.repartition(tasks, "path", "k").mapInArrow(partial(_objects, ahead=ahead), "file string, at long, text string")
