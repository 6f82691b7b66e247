"""Quality scores by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import has_learning_row, small_batches, table
from tillwork.llm.features import ngram_counts, pieces, unit

SAMPLE = 4000  # labelled documents that are fitted on and vote, at most
RAW, SHAPE, REPEATS = 2048, 1024, 8  # columns of byte trigrams, of shape 4-grams, of repeated words
LATENT = 48  # dimensions after the decomposition
NEIGHBOURS = 25
THRESHOLD = 0.3
HELD_OUT = 0  # remainder of crc32(doc_id) by 5 that is never learned from


def repeats(text: bytes) -> np.ndarray:
    """Columns for how much a text says again: a word like the one before it, and words that occurred before."""
    words = text.split()
    row = np.zeros(REPEATS, dtype=np.float32)
    if len(words) > 1:
        again = sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1)
        row[min(3, int(again * 4))] = 20 * again
        share = 1 - len(set(words)) / len(words)
        row[4 + min(3, int(share * 4))] = share
    return row


def counts(texts: list[bytes]) -> np.ndarray:
    """Raw n-gram counts of texts: what they are written with, their shapes, and repetition."""
    return np.concatenate(
        [ngram_counts(texts, "raw", 3, RAW), ngram_counts(texts, "shape", 4, SHAPE), np.array([repeats(t) for t in texts])],
        axis=1,
    )


@dataclass
class QualityModel:
    idf: np.ndarray
    axes: np.ndarray  # latent dimensions by columns
    voters: np.ndarray  # unit rows in the latent space
    labels: np.ndarray

    def weighted(self, texts: list[bytes]) -> np.ndarray:
        return unit(np.log1p(counts(texts)) * self.idf)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The neighbours' labels, weighted by the eighth power of their cosine."""
        if not len(self.voters):
            return np.full(len(texts), 0.5)
        near = unit(self.weighted(texts) @ self.axes) @ self.voters.T  # exact cosines with all voters
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        cosine = np.take_along_axis(near, best, axis=1)
        weight = np.maximum(cosine, 0) ** 8 + 1e-9
        return np.clip((weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1), 0, 1)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all ``texts`` each column occurs, and their number: one partial sum per task. Nulls count as empty."""
    width = RAW + SHAPE + REPEATS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(width, dtype=np.int64), 0
        for batch in batches:
            raw = [(t.as_py() or "").encode("utf-8") for t in batch.column(0)]
            n += len(raw)
            for part in pieces(raw):
                found += (counts(raw[part]) > 0).sum(axis=0)
        used = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(np.append(found, n)[used], pa.int64())], ["i", "n"])

    sums = texts.mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()  # a row for each column
    frequencies = np.zeros(width + 1, dtype=np.int64)
    for row in sums:
        frequencies[row.i] = row.n
    return frequencies[:width], int(frequencies[width])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> QualityModel:
    """Learns from at most SAMPLE labelled documents, chosen by a hash of the id; several labels of one id are averaged, and
    of several texts of one id the one of the smallest hash is taken. Inverse document frequencies cover all ``docs``.
    The sample's columns, a few tens of MB whatever the input, are decomposed on the driver."""
    small_batches(docs.sparkSession)
    ids = labels.select(F.col(id_column).alias("k"), F.col(label_column).cast("double").alias("y")).where("k is not null and y is not null")
    chosen = ids.groupBy("k").agg(F.avg("y").alias("y")).orderBy(F.xxhash64("k"), "k").limit(SAMPLE)
    texts = docs.select(F.col(id_column).alias("k"), F.col(text_column).alias("text")).where("k is not null and text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t.as_py().encode("utf-8") for t in batch.column(2)]
            for part in pieces(found):
                rows = [r.astype("<f2").tobytes() for r in np.log1p(counts(found[part]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part], batch.column(1)[part], pa.array(rows, pa.binary())], ["k", "y", "row"]
                )

    sample = texts.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    ).select(F.col("k").cast("string"), "y", "text")
    rows = sorted(sample.mapInArrow(run, "k string, y double, row binary").collect(), key=lambda r: r.k)  # SAMPLE rows
    width = RAW + SHAPE + REPEATS
    if not rows:
        none = np.zeros((0, LATENT), dtype=np.float32)
        return QualityModel(np.ones(width, dtype=np.float32), np.zeros((width, LATENT), dtype=np.float32), none, np.zeros(0))
    seen = np.array([np.frombuffer(r.row, dtype="<f2") for r in rows], dtype=np.float32)
    holding, n = document_frequencies(docs.select(F.col(text_column).alias("text")))
    idf = (np.log((1 + n) / (1 + holding)) + 1).astype(np.float32)
    seen = unit(seen * idf)
    rng = np.random.default_rng(5)  # a randomised decomposition: a sketch of the row space, sharpened twice
    sketch = seen.T @ (seen @ rng.standard_normal((width, LATENT + 16)).astype(np.float32))
    for _ in range(2):
        sketch = seen.T @ (seen @ np.linalg.qr(sketch)[0])
    basis = np.linalg.qr(sketch)[0]
    axes = (basis @ np.linalg.svd(seen @ basis, full_matrices=False)[2].T)[:, :LATENT].astype(np.float32)
    return QualityModel(idf, axes, unit(seen @ axes), np.array([r.y for r in rows]))


def score_quality(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from the whole text only; higher: label 1 is likelier.

    Null texts count as empty; an empty text is near nothing and gets the plain vote of the voters it happens to meet.
    Without labelled documents every score is 0.5. Repeated rows and null ids are kept; an empty table gives no rows;
    other columns are not read."""
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # about 2 MB at most, fixed by SAMPLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = QualityModel(**sent.value)
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8") for t in batch.column(1)]
            scores = [known.score(texts[part]) for part in pieces(texts)]
            score = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), score], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit(docs, labels.where(has_learning_row("doc_id", 5, HELD_OUT)))
    return score_quality(docs, model).select(
        "doc_id",
        (~has_learning_row("doc_id", 5, HELD_OUT)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
