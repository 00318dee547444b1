"""Fetching as a data source: ``spark.read.format("lexmill_pages")``, also as a stream.

The folder of URLs (option ``path``, Parquet with a column ``url``, in folders
``host_group=...`` as ``prepare`` writes them) has all URLs of a host in one group.  A group is a
partition, which is one task's, so that ``rate``, the requests a second to a host, holds for
the whole job.  As a stream the source reads the batches of URLs that arrive as folders below
``path``, in the order of their names; an offset is the name of the last one.

``opener`` names a function ``module:name`` that returns the bytes behind a URL; it is
``lexmill.sources.fetch:http_get`` unless another is given.  A failure is a row with an error.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from importlib import import_module

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from lexmill.sources.fetch import ROWS, packed, tried

SCHEMA = "url string, host string, content binary, error string"
_ROW = pa.schema([("url", pa.string()), ("host", pa.string()), ("content", pa.binary()), ("error", pa.string())])


def prepare(urls: DataFrame, path: str, groups: int = 64, url: str = "url", host: Column | None = None) -> None:
    """Writes URLs, all of a host in one of ``groups`` folders, sorted by host; ``host`` says which servers count as one."""
    own = F.lower(F.regexp_extract(F.col(url), r"://([^/?#]*)", 1)) if host is None else host
    rows = urls.select(F.col(url).alias("url"), own.alias("host")).where("url is not null").distinct()
    rows = rows.withColumn("host_group", F.pmod(F.xxhash64("host"), F.lit(groups)).cast("int"))
    rows.repartition("host_group").sortWithinPartitions("host_group", "host", "url").write.partitionBy("host_group").parquet(path)


def _function(name: str) -> Callable[[str], bytes]:
    module, _, own = name.partition(":")
    return getattr(import_module(module), own)


def _folders(path: str) -> list[str]:
    """The folders right below a path, as URIs."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f"{path.rstrip('/')}/{f.base_name}" for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith(("_", ".")))


@dataclass
class Group(InputPartition):
    """The URLs of some hosts."""

    path: str

    def __post_init__(self) -> None:
        super().__init__(self.path)


class _Fetching:
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.opener = options.get("opener", "lexmill.sources.fetch:http_get")
        self.rate = float(options.get("rate", "1"))

    def _rows(self, group: Group) -> Iterator[tuple]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        get, (system, root) = _function(self.opener), fs.FileSystem.from_uri(group.path)
        host, asked = None, 0.0  # hosts come one after another
        for info in sorted(system.get_file_info(fs.FileSelector(root)), key=lambda f: f.base_name):
            if not info.base_name.endswith(".parquet"):
                continue
            with system.open_input_file(info.path) as source:
                for batch in pq.ParquetFile(source).iter_batches(ROWS, columns=["url", "host"]):
                    for url, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                        if self.rate > 0 and own == host and (wait := asked + 1 / self.rate - time.monotonic()) > 0:
                            time.sleep(wait)
                        host, asked = own, time.monotonic()
                        yield (url, own, *tried(get, url))

    def _fetched(self, group: Group) -> Iterator[pa.RecordBatch]:
        yield from packed(self._rows(group), _ROW, lambda r: len(r[2] or b""))


class _Reader(_Fetching, DataSourceReader):
    def partitions(self) -> list[Group]:
        return [Group(f) for f in _folders(self.path)]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        yield from self._fetched(partition)


class _StreamReader(_Fetching, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"after": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"after": max((f.rsplit("/", 1)[-1] for f in _folders(self.path)), default="")}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        arrived = [f for f in _folders(self.path) if start["after"] < f.rsplit("/", 1)[-1] <= end["after"]]
        return [Group(g) for f in arrived for g in _folders(f)]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        yield from self._fetched(partition)


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lexmill_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self.options)
