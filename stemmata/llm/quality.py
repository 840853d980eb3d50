"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

Features are counts of hashed byte trigrams, damped and weighted by inverse document frequency, plus a
few measures of form; a truncated singular value decomposition of a bounded labelled sample gives the
latent space. The sample's vectors, their labels and the projection are broadcast (their size is fixed by
the parameters below). Every document is projected, its cosines with all sample vectors are computed
exactly in blocks, and its ``NEIGHBOURS`` nearest vote with weights that rise with similarity.

Results by case: null and empty texts have the zero vector, so that all cosines are 0, and get the share
of label 1; without labelled rows every score is 0.5; null labels and doc_ids teach nothing; repeated
rows are scored alike; extra columns stay, and a column ``score`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import SLICE, as_bytes

#: Labelled rows of the sample, at most (in the mean); a hash of doc_id thins a larger set.
SAMPLE = 4000
#: Buckets of hashed trigrams, dimensions of the latent space, neighbours that vote.
FEATURES, DIMENSIONS, NEIGHBOURS = 2048, 48, 25
#: A neighbour of cosine c weighs exp(SHARPNESS * (c - 1)).
SHARPNESS = 12.0
#: Measures of form beside the trigrams, and their weight.
FORMS, FORM_WEIGHT = 7, 2.0
#: Documents of which cosines are held at once.
BLOCK = 256


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray  #: unit length
    labels: np.ndarray
    prior: float


def _trigrams(data: bytes) -> np.ndarray:
    """Counts of hashed trigrams of bytes, A-Z as a-z."""
    total = np.zeros(FEATURES, np.int64)
    low = data.lower()
    for at in range(0, max(len(low) - 2, 0), SLICE):
        x = np.frombuffer(low[at : at + SLICE + 2], np.uint8).astype(np.uint32)
        code = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))
        total += np.bincount((code * np.uint32(0x27D4EB2F)) >> np.uint32(21), minlength=FEATURES)
    return total


def features(data: bytes) -> np.ndarray:
    """One row: damped frequencies of trigrams, then measures of form between 0 and 1."""
    counts = _trigrams(data)
    n = counts.sum()
    out = np.zeros(FEATURES + FORMS, np.float32)
    if not n:
        return out
    out[:FEATURES] = np.sqrt(counts / n)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, seen = len(data), counts > 0
    upper, lower, digit = bytes_[65:91].sum(), bytes_[97:123].sum() + bytes_[128:].sum(), bytes_[48:58].sum()
    white = bytes_[32] + bytes_[9:14].sum()
    words = data.split()
    again = sum(map(bytes.__eq__, words, words[1:])) / max(len(words) - 1, 1)
    out[FEATURES:] = again, upper / size, digit / size, white / size, max(size - upper - lower - digit - white, 0) / size, seen.sum() / min(FEATURES, n), float((counts / n).max())
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array([features(t).tobytes() for t in as_bytes(b.column(0))], pa.binary())], names=["y", "x"])


def _weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    y = x.copy()
    y[:, :FEATURES] *= idf
    y[:, FEATURES:] *= FORM_WEIGHT
    return y


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 1e-12)


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", label: str = "quality", doc_id: str = "doc_id") -> Model:
    """Fit on a bounded sample of the texts with a label 0 or 1 (the smaller of several)."""
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    share = min(1.0, SAMPLE / max(1, known.count()))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(known), "id").select("text", "y").mapInArrow(_rows, "y int, x binary").collect()  # SAMPLE rows
    if not rows:
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES + FORMS, 1), np.float32), np.zeros((1, 1), np.float32), np.array([0.5], np.float32), 0.5)
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(len(rows), -1)
    y = np.array([r.y for r in rows], np.float32)
    order = np.lexsort(x[:, :8].T)  # the same model from rows in any order
    x, y = x[order], y[order]
    idf = np.log((len(x) + 1) / ((x[:, :FEATURES] > 0).sum(axis=0) + 1)).astype(np.float32) + 0.2
    m = _weighted(x, idf)
    k = min(DIMENSIONS, len(x))
    gram = m.T @ m
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :k]).astype(np.float32)
    return Model(idf, projection, _unit(m @ projection), y, float(y.mean()))


def vote(model: Model, x: np.ndarray) -> np.ndarray:
    """Scores of rows of features."""
    out = np.empty(len(x))
    k = min(NEIGHBOURS, len(model.labels))
    for at in range(0, len(x), BLOCK):
        v = _unit(_weighted(x[at : at + BLOCK], model.idf) @ model.projection)
        cosines = v @ model.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        w = np.exp(SHARPNESS * (np.take_along_axis(cosines, near, axis=1).astype(np.float64) - 1))
        votes = (w * model.labels[near]).sum(axis=1) / w.sum(axis=1)
        out[at : at + BLOCK] = np.where((v == 0).all(axis=1), model.prior, votes)
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add ``score`` to every row."""
    names = [c for c in docs.columns if c != "score"]
    used = [*names, text] if text not in names else names
    at = used.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = []
            for lo in range(0, b.num_rows, BLOCK):
                x = np.stack([features(t or b"") for t in as_bytes(b.column(at).slice(lo, BLOCK))])
                scores.append(vote(model, x))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*names, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in names]).schema.fields]
    return docs.select(*[f"`{c}`" for c in used]).mapInArrow(run, ", ".join([*fields, "score double"]))
