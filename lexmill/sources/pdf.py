"""PDF documents: text by whichever engine is installed, tables where one can read them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from io import BytesIO

import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.sources.fetch import packed

TEXTS = "path string, text string, tables array<array<array<string>>>, error string"
# The published documents of the specification, and the prefix of their nodes' paths.
DOCUMENTS = {
    "technical_description": ("norwegian-saf-t-financial-data---technical-description.pdf", ""),
    "header": ("header.pdf", "Header"),
    "masterfiles": ("masterfiles.pdf", "MasterFiles"),
    "generalledger": ("generalledgerentries.pdf", "GeneralLedgerEntries"),
}
BASE_URL = "https://www.skatteetaten.no/globalassets/bedrift-og-organisasjon/starte-og-drive/rutiner-regnskap-og-kassasystem/saf-t-regnskap/oppdateringer-mars-2024/"


def _mupdf(content: bytes) -> str:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        return "".join(page.get_text() + "\n" for page in doc)


def _plumber(content: bytes) -> str:
    import pdfplumber

    with pdfplumber.open(BytesIO(content)) as doc:
        return "".join(text + "\n" for page in doc.pages if (text := page.extract_text()))


def _pypdf(content: bytes) -> str:
    from pypdf import PdfReader

    return "".join(page.extract_text() + "\n" for page in PdfReader(BytesIO(content)).pages)


def _plumber_tables(content: bytes) -> list[list[list[str | None]]]:
    import pdfplumber

    with pdfplumber.open(BytesIO(content)) as doc:
        return [table for page in doc.pages for table in page.extract_tables() or []]


ENGINES: tuple[Callable[[bytes], str], ...] = (_mupdf, _plumber, _pypdf)


def read(content: bytes, engines: tuple[Callable[[bytes], str], ...] = ENGINES, tables: Callable[[bytes], list] = _plumber_tables) -> tuple[str, list, str | None]:
    """(text, tables, error): the first engine that gives text counts; engines that are missing or fail are noted."""
    text, notes = "", []
    for engine in engines:
        try:
            text = engine(content)
        except Exception as e:  # a document or an engine; the next one is tried
            notes.append(f"{engine.__name__}: {e}")
        if text.strip():
            break
    try:
        found = tables(content)
    except Exception as e:
        found = []
        notes.append(f"tables: {e}")
    return text, found, None if text.strip() or found else "; ".join(notes) or "no text"


def read_documents(files: DataFrame, engines: tuple[Callable[[bytes], str], ...] = ENGINES, tables: Callable[[bytes], list] = _plumber_tables) -> DataFrame:
    """(path, text, tables, error) of each (path, content)."""

    schema = pa.schema([("path", pa.string()), ("text", pa.string()), ("tables", pa.list_(pa.list_(pa.list_(pa.string())))), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield from packed(((path, *read(content or b"", engines, tables)) for path, content in given), schema, lambda r: len(r[1]))

    return files.select("path", "content").mapInArrow(run, TEXTS)
