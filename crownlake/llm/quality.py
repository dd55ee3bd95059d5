"""Quality scores by nearest-neighbour voting among labelled documents.

A document is described by the hashed counts of its byte trigrams and a few
shape measures, damped by square roots, weighted and projected to a
latent-semantic space (truncated SVD of the labelled sample). The labelled
vectors, at most ``train_rows`` of ``RANK`` numbers, go to every task; each
document's cosines to all of them are computed exactly, in blocks, and the
labels of the nearest ones vote with a power of their cosine as weight.

The fit uses at most ``train_rows`` labelled texts, spread evenly over the two
labels by a hash of the id, which is the documented bound of its sample. Votes
are weighed back to the labels' shares among all labelled rows.

Defined cases: a null or empty text has no vector; its score is the share of
label 1. Without labelled rows every score is 0.5. Repeated rows get one score
each. Rows with a null id or label are not learnt from. An empty table gives an
empty result. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownlake.llm.common import prepare, texts, utf8_bytes

TRAIN_ROWS = 3000
HASHED = 2048
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 8.0
BLOCK = 256
THRESHOLD = 0.3

# Classes of bytes for the shape measures: lower case, upper case, digits, white space, other ASCII, the rest.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[:128] = 4
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
CLASSES = 6
# Bytes that equal the byte so many places on: high where a word repeats.
LAGS = range(3, 13)


def features(batch: pa.Array) -> np.ndarray:
    """Square-rooted shares of hashed byte trigrams, of pairs of byte classes and of repeats at each lag, one row a text."""
    data, offsets = utf8_bytes(batch)
    n, sizes = len(batch), np.diff(offsets)
    of = np.repeat(np.arange(n, dtype=np.int64), sizes)
    out = np.zeros((n, HASHED + CLASSES * CLASSES + len(LAGS)))
    width = CLASSES * CLASSES
    if len(data) > 2:
        x = data.astype(np.uint32)
        codes = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
        inside = of[:-2] == of[2:]
        slot = ((codes * np.uint32(2654435761)) >> np.uint32(32 - HASHED.bit_length() + 1)).astype(np.int64)
        out[:, :HASHED] = np.bincount((of[:-2] * HASHED + slot)[inside], minlength=n * HASHED).reshape(n, HASHED)
    if len(data) > 1:
        kinds = _CLASS[data].astype(np.int64)
        pairs = kinds[:-1] * CLASSES + kinds[1:]
        inside = of[:-1] == of[1:]
        out[:, HASHED : HASHED + width] = np.bincount((of[:-1] * width + pairs)[inside], minlength=n * width).reshape(n, width)
    for j, lag in enumerate(LAGS):
        same = (data[:-lag] == data[lag:]) & (of[:-lag] == of[lag:])
        out[:, HASHED + width + j] = np.bincount(of[:-lag][same], minlength=n)
    return np.sqrt(out / np.maximum(sizes, 1)[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    centre: np.ndarray
    axes: np.ndarray  # columns of the latent space
    vectors: np.ndarray  # labelled unit vectors, a column each
    labels: np.ndarray
    weights: np.ndarray  # of a labelled row, to bring back the labels' shares
    share: float  # of label 1

    def project(self, rows: np.ndarray) -> np.ndarray:
        return unit((rows - self.centre) @ self.axes).astype(np.float32)

    def score(self, batch: pa.Array) -> np.ndarray:
        """Share of label 1 in the weighted vote for each text of a string array without nulls."""
        out = np.full(len(batch), self.share)
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(batch), BLOCK):
            block = batch.slice(at, BLOCK)
            cosines = self.project(features(block)) @ self.vectors
            near = np.argpartition(cosines, -k, axis=1)[:, -k:]
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6) ** SHARPNESS * self.weights[near]
            got = (votes * self.labels[near]).sum(axis=1) / votes.sum(axis=1)
            empty = np.array([len(t.as_buffer() or b"") == 0 for t in block], bool)
            out[at : at + BLOCK] = np.where(empty, self.share, got)
        return np.clip(out, 0.0, 1.0)


def sample(docs: DataFrame, labels: DataFrame, train_rows: int) -> tuple[pd.DataFrame, dict[int, int]]:
    """At most ``train_rows`` labelled texts in equal parts of each label as far as they go, and the labels' counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = {int(r["quality"]): int(r["n"]) for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return pd.DataFrame({"text": [], "quality": []}), counts
    small = min(counts.values())
    quota = {q: min(n, max(train_rows // 2, train_rows - small)) for q, n in counts.items()}
    share = F.pmod(F.xxhash64("doc_id", F.lit("label")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    bar = F.when(F.col("quality") == 1, min(1.0, 1.1 * quota.get(1, 0) / counts.get(1, 1))).otherwise(min(1.0, 1.1 * quota.get(0, 0) / counts.get(0, 1)))
    chosen = known.where(share < bar).orderBy(share / bar, "doc_id").limit(train_rows)
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality").toPandas()
    return rows.sort_values(["doc_id", "text"]).drop_duplicates("doc_id"), counts


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on the labelled rows given (labels: doc_id, quality); None if there are none."""
    rows, counts = sample(docs, labels, train_rows)
    if rows.empty:
        return None
    sampled = pa.array(rows["text"].tolist(), pa.string())
    described = np.concatenate([features(sampled.slice(at, BLOCK)) for at in range(0, len(sampled), BLOCK)])
    centre = described.mean(axis=0)
    # Axes of the latent space: leading eigenvectors of the sample's scatter.
    values, axes = np.linalg.eigh((described - centre).T @ (described - centre))
    axes = axes[:, ::-1][:, :RANK]
    y = rows["quality"].to_numpy().astype(float)
    share = counts.get(1, 0) / sum(counts.values())
    # Each label's rows together weigh as its square-rooted share: rare labels keep a voice.
    drawn = np.maximum(np.array([(y == 0).sum(), (y == 1).sum()]), 1)
    pull = np.sqrt(np.array([1 - share, share])) / drawn
    model = Model(centre, axes, np.zeros((0, 0)), y, (pull / pull.max())[y.astype(int)], share)
    model.vectors = np.ascontiguousarray(model.project(described).T)
    return model


def score_texts(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with a column ``score``; only ``text`` is read."""
    prepare(docs.sparkSession)
    if model is None:
        return docs.withColumn("score", F.lit(0.5))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(sent.value.score(batch.fill_null("")), pa.float64())

    return docs.withColumn("score", vote(F.coalesce(F.col("text"), F.lit(""))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def quality_report(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; rows whose id's crc32 is a multiple of 5 are not learnt from."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))), train_rows)
    scored = score_texts(texts(docs), model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
