"""Secret scans (operator 8): keyword prefilter, anchored patterns, checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over a text; a
kind's pattern is then tried only where one of its keywords stands.  Runs of lower-case
hex digits have no keyword and are found by their own scan.  Kinds whose secrets carry a check
of themselves count only if it holds: tokens with a CRC-32 at their end, signed tokens whose
header is JSON that names an algorithm, private keys whose body has the length it declares.

Time is linear in the length of a text: where a kind's pattern fails on a run of characters,
the rest of the run isn't tried again.

Defined results: a null or empty text has no spans; texts of any length are scanned
whole; equal spans of one kind cannot occur; every input row gives one output row, also
repeated rows and rows whose id is null; an empty table gives no rows.  Columns of the input
named as an output column are replaced, and any other name is kept.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import words

#: Where a secret of a base kind is shorter than this, it is dropped.
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

_B62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_tail(secret: str) -> bool:
    """The last six characters are the CRC-32, in base 62, of what stands between prefix and them."""
    body = secret[secret.index("_") + 1 :]
    number = 0
    for c in body[-6:]:
        number = number * 62 + _B62.index(c)
    return number == zlib.crc32(body[:-6].encode())


def _json_header(secret: str) -> bool:
    """The first part of a signed token is base64url of a JSON object that names an algorithm."""
    head = secret.split(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


def _key_body(secret: str) -> bool:
    """The body is base64 of a DER sequence of just its length, or of a key in the OpenSSH format."""
    try:
        raw = base64.b64decode("".join(secret.split("-----")[2].split()), validate=True)
    except ValueError:
        return False
    if raw.startswith(b"openssh-key-v1\0"):
        return True
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    if raw[1] < 0x80:
        return len(raw) == 2 + raw[1]
    n = raw[1] & 0x7F
    return len(raw) == 2 + n + int.from_bytes(raw[2 : 2 + n], "big")


@dataclass(frozen=True)
class Kind:
    name: str
    keywords: tuple[str, ...]  # lower case; each match starts with one of them
    pattern: re.Pattern
    least: int = 0  # characters of the secret
    group: int = 0  # which holds the secret
    check: object = None
    run: re.Pattern | None = None  # what a failed match can't begin in again


#: In the order in which spans with equal starts are listed.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "apikey", "api_key"), re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), MIN_ASSIGN, 2),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), MIN_ACCESS),
    Kind("hex", (), re.compile(r"[0-9a-f]{%d,}" % MIN_HEX), MIN_HEX),
    Kind("forge", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), check=_crc_tail),
    Kind("registry", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), check=_crc_tail),
    Kind("signed", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{16,}+"), check=_json_header, run=re.compile(r"[A-Za-z0-9_-]+")),
    Kind("private", ("-----begin",), re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]{64,}+-----END (?:[A-Z]+ )?PRIVATE KEY-----"), check=_key_body),
)
BASE = ("assign", "access", "hex")
_RANK = {kind.name: i for i, kind in enumerate(KINDS)}
_UPPER = {c: c + 0x20 for c in range(0x41, 0x5B)}


@cache
def _automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for kind in KINDS:
        for word in kind.keywords:
            made.add_word(word, (kind.name, len(word)))
    made.make_automaton()
    return made


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each secret: code points, end exclusive, by start and kind.

    Matches of a kind are leftmost and do not overlap; one that is too short or fails its
    check still takes its characters, as with a plain scan by the kind's pattern.
    """
    if not text:
        return []
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer
        low = text.translate(_UPPER)
    found, free = [], dict.fromkeys(_RANK, 0)
    by_name = {kind.name: kind for kind in KINDS}
    for last, (name, size) in _automaton().iter(low):
        start, kind = last + 1 - size, by_name[name]
        if start < free[name]:
            continue
        if not (m := kind.pattern.match(text, start)):
            if kind.run:
                free[name] = kind.run.match(text, start).end()
            continue
        free[name] = m.end()
        if len(m[kind.group]) >= kind.least and (kind.check is None or kind.check(m[0])):
            found.append((name, start, m.end()))
    found += [("hex", *m.span()) for m in by_name["hex"].pattern.finditer(text)]
    return sorted(found, key=lambda x: (x[1], _RANK[x[0]]))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch], at: int, redacted: int | None, mark: str) -> Iterator[pa.RecordBatch]:
    for batch in words.sliced(batches, at):
        texts = batch.column(at).to_pylist()
        spans = [find(x) for x in texts]
        columns = batch.columns
        if redacted is not None:
            columns[redacted] = pa.array([_without(x, s, mark) if s else x for x, s in zip(texts, spans, strict=True)], columns[redacted].type)
        out = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], _ARROW)
        yield pa.RecordBatch.from_arrays([*columns, out], names=[*(f"c{i}" for i in range(len(columns))), "spans"])


def _without(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """Adds the array of (kind, start, end) of the secrets in ``text``."""
    return _apply(docs, text, spans, None, "")


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """Replaces each secret in ``text``, overlapping ones as one, by ``mark``."""
    return _apply(docs, text, "spans", text, mark).drop("spans") if "spans" not in docs.columns else _apply(docs.withColumnRenamed("spans", "__spans"), text, "spans", text, mark).drop("spans").withColumnRenamed("__spans", "spans")


def _apply(docs: DataFrame, text: str, spans: str, redacted: str | None, mark: str) -> DataFrame:
    names = [c for c in docs.columns if c != spans]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    at = names.index(text)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)] + [T.StructField("spans", SPANS)])
    out = docs.mapInArrow(lambda it: _scan(it, at, at if redacted else None, mark), schema)
    return out.toDF(*names, spans)
