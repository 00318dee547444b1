"""Quality classifier (operator 10): regularised quadratic discriminant analysis.

Each text is described by transformed statistics of its characters, words and lines.  A
class has a mean and a covariance that is shrunk towards the pooled covariance and towards
a multiple of the identity.  The Cholesky factors of the shrunk covariances are computed
once, when the model is fitted, and kept in it; a score is the logistic of the difference
of the two Mahalanobis log densities plus the log odds of the classes.

Statistics cover the whole text, and class moments all labelled rows (sums, so fitting is
one aggregation whose result has two rows).

Defined results: a null text counts as empty; an empty text has the statistics of zero
words and gets a score like any other; texts of any length are read whole; an empty table
gives no rows; label rows with a null label, a null id or without
a document are ignored; a document labelled several times counts once per label row; if
the labelled rows lack a class, every score is the share of the class 1 (0.5 without any
labelled row).  Repeated rows each get a score.  Columns of the input named as an output
column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.llm import words

FEATURES = ("log_words", "word_length", "upper", "digit", "exclaim", "symbol", "punctuation", "accent", "distinct_words", "distinct_triples", "line_words")

# Classes of bytes: 0 other, 1 upper, 2 digit, 3 exclaim, 4 symbol, 5 punctuation, 6 line feed, 7 part of a longer character.
_CLASS = np.zeros(256, np.int64)
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[ord(c) for c in "!?"]] = 3
_CLASS[[ord(c) for c in "#$%&*+<=>@[\\]^_`{|}~/"]] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[0x0A] = 6
_CLASS[0x80:] = 7


def _distinct(hashes: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The number of distinct hashes of each text; sorts the hashes in place."""
    out = np.zeros(len(where) - 1)
    for i, (a, b) in enumerate(zip(where[:-1].tolist(), where[1:].tolist(), strict=True)):
        if b > a:
            own = hashes[a:b]
            own.sort()
            out[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    return out


def features(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A row of FEATURES for each text."""
    raw, offsets = words.text_bytes(column)
    n = len(offsets) - 1
    counts = np.zeros((n, 8))
    for i in range(n):
        counts[i] = np.bincount(_CLASS[raw[offsets[i] : offsets[i + 1]]], minlength=8)
    hashes, where = words.tokens(column)
    sizes = np.diff(where).astype(float)
    triples, starts = words.windows(hashes, where, 3)
    edges = np.searchsorted(starts, where)
    size = np.diff(offsets).astype(float)
    rate = lambda k: np.log((counts[:, k] + 0.5) / (size + 20))
    part = lambda a, b: np.log((b - a + 0.5) / (b + 20))
    columns = [
        np.log1p(sizes),
        np.log((size + 5) / (sizes + 1)),
        *(rate(k) for k in (1, 2, 3, 4, 5, 7)),
        part(_distinct(triples, edges), np.diff(edges)),
        np.log1p(sizes / (counts[:, 6] + 1)),
    ]
    columns.insert(8, part(_distinct(hashes, where), sizes))  # last, as it sorts the hashes
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Model:
    """Two classes: log odds of class 1, means, and the inverse Cholesky factors with their log determinants."""

    prior: float
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    half_logdets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        log_density = [-0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) - h for m, f, h in zip(self.means, self.factors, self.half_logdets, strict=True)]
        margin = self.prior + (log_density[1] - log_density[0] if len(log_density) == 2 else np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.sliced(batches, 1):
        x = features(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, i]) for i in range(x.shape[1]))], names=["id", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", to_pooled: float = 0.35, to_identity: float = 0.02, unpaired: Column | None = None) -> Model:
    """Fits the model to the labelled documents; ``unpaired`` selects label rows to leave out.

    ``to_pooled`` is the weight of the pooled covariance in that of a class, ``to_identity``
    that of the identity (features are standardised first).
    """
    schema = T.StructType([T.StructField("id", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in FEATURES)])
    rows = docs.select(F.col(id).cast("long"), F.col(text)).mapInArrow(_feature_rows, schema)
    known = labels if unpaired is None else labels.where(~F.coalesce(unpaired, F.lit(False)))
    known = known.select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    d = len(FEATURES)
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(FEATURES)]
    squares = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"q{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = {r["label"]: r for r in rows.join(known, "id").groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *squares).collect()}
    counts = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    total = sum(counts)
    share = counts[1] / total if total else 0.5
    if min(counts) == 0:
        margin = 500.0 if share == 1 else -500.0 if total else 0.0
        return Model(margin, np.zeros(d), np.ones(d), np.zeros((0, d)), np.zeros((0, d, d)), np.zeros(0))
    means, covs = [], []
    for k in (0, 1):
        r = found[k]
        m = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        q = np.array([[r[f"q{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) / r["n"]
        means.append(m)
        covs.append(q - np.outer(m, m))
    pooled = sum(c * n for c, n in zip(covs, counts, strict=True)) / total
    centre = sum(m * n for m, n in zip(means, counts, strict=True)) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    factors, halves = [], []
    for c in covs:
        shrunk = ((1 - to_pooled) * c + to_pooled * pooled) / np.outer(scale, scale)
        shrunk = (1 - to_identity) * shrunk + to_identity * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        halves.append(np.log(np.diag(lower)).sum())
    return Model(float(np.log(counts[1] / counts[0])), centre, scale, np.array([(m - centre) / scale for m in means]), np.array(factors), np.array(halves))


def _scores(batches: Iterator[pa.RecordBatch], at: int, model: Model, dropped: bool) -> Iterator[pa.RecordBatch]:
    for batch in words.sliced(batches, at):
        out = pa.array(model.score(features(batch.column(at))), pa.float64())
        rest = [c for i, c in enumerate(batch.columns) if not (dropped and i == at)]
        yield pa.RecordBatch.from_arrays([*rest, out], names=[*(f"c{i}" for i in range(len(rest))), "score"])


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds ``score`` (0 to 1, higher for class 1) and ``predicted`` (1 from 0.5 on)."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    at = names.index(text)
    kept = [i for i in range(len(names)) if keep_text or i != at]
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[k].dataType) for i, k in enumerate(kept)] + [T.StructField("score", T.DoubleType())])
    out = docs.mapInArrow(lambda it: _scores(it, at, model, not keep_text), schema).toDF(*(names[k] for k in kept), "score")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
