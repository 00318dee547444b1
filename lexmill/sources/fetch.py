"""Fetching: pages and documents over HTTP, with retries, inside executors.

Any callable from a URL to bytes can stand in for HTTP.  A failure is a row, not an
exception: the other sources of its task go on.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.settings import Settings

RETRIED = frozenset((500, 502, 503, 504))
FETCHED = "source_id string, url string, content binary, error string"


def http_get(url: str, settings: Settings = Settings(), opener: Callable = urlopen, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of a URL; server errors and lost connections are tried again, later each time."""
    request = Request(url, headers={"User-Agent": settings.user_agent})
    for attempt in range(settings.http_retries + 1):
        try:
            with opener(request, timeout=settings.http_timeout) as answer:
                return answer.read()
        except HTTPError as e:
            if e.code not in RETRIED or attempt == settings.http_retries:
                raise
        except (URLError, TimeoutError):
            if attempt == settings.http_retries:
                raise
        sleep(settings.http_backoff * 2**attempt)
    raise AssertionError("unreachable")


#: Bytes and rows that are handed over at once.
BYTES, ROWS = 1 << 22, 1024


def packed(rows: Iterable[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a bounded size."""
    held: list[tuple] = []
    total = 0
    make = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BYTES or len(held) >= ROWS:
            yield make()
            held, total = [], 0
    if held:
        yield make()


def tried(get: Callable[[str], bytes], url: str) -> tuple[bytes | None, str | None]:
    """The content of a URL, or what went wrong."""
    try:
        return get(url), None
    except Exception as e:  # of whatever fetcher; the row says what happened
        return None, f"{type(e).__name__}: {e}"


def fetch(sources: DataFrame, get: Callable[[str], bytes] = http_get, partitions: int | None = None) -> DataFrame:
    """(source_id, url, content, error) of each source, fetched in parallel."""

    schema = pa.schema([("source_id", pa.string()), ("url", pa.string()), ("content", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield from packed(((source_id, url, *tried(get, url)) for source_id, url in asked), schema, lambda r: len(r[2] or b""))

    rows = sources.select(F.col("source_id").cast("string"), F.col("url").cast("string"))
    return (rows.repartition(partitions) if partitions else rows).mapInArrow(run, FETCHED)
