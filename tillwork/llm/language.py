"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import has_learning_row, small_batches, table
from tillwork.llm.features import ngram_counts, pieces, unit

SIZE = 4096  # columns that letter trigrams are hashed to
CENTROIDS = 4  # per language
SAMPLE = 1000  # labelled texts per language that centroids are fitted on, about; all, where there are fewer
SLACK = 0.5  # a text is rejected below this share of the lowest cosine that a centroid's own texts have
FULL = 400  # a text of fewer different trigrams has a lower cosine by nature: its limit falls with their root
UNKNOWN = "und"
LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    languages: list[str]  # of each centroid
    least: np.ndarray  # cosine of each centroid below which a text is rejected

    def vectors(self, texts: list[bytes]) -> np.ndarray:
        return unit(np.log1p(ngram_counts(texts, "letters", 3, SIZE)) * self.idf)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of each text the language, the cosine to the nearest centroid, and whether it is too far away."""
        if not texts or not len(self.centroids):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        vectors = self.vectors(texts)
        near = vectors @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(texts)), best], 0, 1)
        share = np.sqrt(np.minimum((vectors > 0).sum(axis=1) / FULL, 1))
        return [self.languages[b] for b in best], score, score < self.least[best] * share


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8")


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all ``docs`` (text) each column occurs, and their number: one partial sum per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            texts = [lowered(t.as_py()) for t in batch.column(0)]
            n += len(texts)
            for part in pieces(texts):
                found += (ngram_counts(texts[part], "letters", 3, SIZE) > 0).sum(axis=0)
        used = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(np.append(found, n)[used], pa.int64())], ["i", "n"])

    sums = docs.mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()  # SIZE rows
    frequencies = np.zeros(SIZE + 1, dtype=np.int64)
    for row in sums:
        frequencies[row.i] = row.n
    return frequencies[:SIZE], int(frequencies[SIZE])


def clusters(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out starting rows; the unit centroids."""
    chosen = [rows.mean(axis=0)]
    while len(chosen) < min(k, len(rows)) + 1:
        nearest = (rows @ unit(np.array(chosen)).T).max(axis=1)
        chosen.append(rows[int(nearest.argmin())])
    centroids = unit(np.array(chosen[1:]))
    for _ in range(rounds):
        own = (rows @ centroids.T).argmax(axis=1)
        centroids = unit(np.array([rows[own == c].mean(axis=0) for c in range(len(centroids)) if (own == c).any()]))
    return centroids


def fit(labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Learns from ``labelled`` rows with a text and a language. Inverse document frequencies cover all of them; the
    centroids come from about SAMPLE texts per language: those of the smallest hashes of id and text, up to the share that
    SAMPLE is of the language's (counted to 2 %). Repeated rows are one, so neither null nor repeated ids, nor any order of
    rows, make a difference to it. Texts that stand nearer to the mean of another language are left out as mislabelled."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(
        F.xxhash64(F.col(id_column), F.col(text_column)).alias("h"), F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).where("text is not null and lang is not null").where(F.col("text").rlike(LETTER))
    seen, n = document_frequencies(rows.select("text"))
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    blank = LanguageModel(idf, np.zeros((0, SIZE), dtype=np.float32), [], np.zeros(0))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()  # a number for each language
    limits = [(r.lang, -(1 << 63) + (1 << 64) * SAMPLE // r.n if r.n > SAMPLE else (1 << 63) - 1) for r in sizes]
    limit = F.create_map(*[x for lang, top in limits for x in (F.lit(lang), F.lit(top).cast("long"))])[F.col("lang")] if limits else F.lit(None)
    sample = rows.where(F.col("h") <= limit).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def vectors_of(part: pa.Table) -> np.ndarray:
        texts = sorted({lowered(t.as_py()) for t in part.column("text")})
        return np.concatenate([blank.vectors(texts[p]) for p in pieces(texts)])

    def packed(lang: str, centroids: np.ndarray, least: list[float]) -> pa.Table:
        values = pa.array([c.astype("<f4").tobytes() for c in centroids], pa.binary())
        return pa.table({"lang": [lang] * len(centroids), "centroid": values, "least": pa.array(least, pa.float64())})

    def fit_mean(part: pa.Table) -> pa.Table:
        return packed(part.column("lang")[0].as_py(), unit(vectors_of(part).mean(axis=0, keepdims=True)), [0.0])

    def fit_language(part: pa.Table) -> pa.Table:
        lang, vectors = part.column("lang")[0].as_py(), vectors_of(part)
        nearest = (vectors @ means.T).argmax(axis=1)  # texts nearer to another language's mean are taken as mislabelled
        own = vectors[np.array([names[i] == lang for i in nearest])]
        vectors = own if len(own) else vectors
        centroids = clusters(vectors, CENTROIDS)
        near = vectors @ centroids.T
        best, score = near.argmax(axis=1), near.max(axis=1)
        return packed(lang, centroids, [float(score[best == c].min(initial=1)) for c in range(len(centroids))])

    shape = "lang string, centroid binary, least double"
    chosen = sample.select("lang", "text")
    middle = sorted(chosen.groupBy("lang").applyInArrow(fit_mean, shape).collect(), key=lambda r: r.lang)
    names = [r.lang for r in middle]
    means = np.array([np.frombuffer(r.centroid, dtype="<f4") for r in middle])
    found = chosen.groupBy("lang").applyInArrow(fit_language, shape)
    fitted = sorted(found.collect(), key=lambda r: (r.lang, r.centroid))  # CENTROIDS rows a language
    if not fitted:
        return blank
    centroids = np.array([np.frombuffer(r.centroid, dtype="<f4") for r in fitted])
    return LanguageModel(idf, centroids, [r.lang for r in fitted], np.array([r.least * SLACK for r in fitted]))


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row, from the whole text only.

    ``lang_pred`` is the language of the nearest centroid and ``score`` its cosine, 0 to 1. ``rejected`` is true where
    that cosine is far below what the centroid's own texts have, and always without a letter: a null, empty or
    letterless text is `und` with score 0. Ties go to the first language by name. Repeated rows and null ids are kept;
    an empty table gives no rows; other columns are not read."""
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return annotate(source, model, "text").drop("text")


def annotate(docs: DataFrame, model: LanguageModel, text_column: str) -> DataFrame:
    """``docs`` with lang_pred, score and rejected behind its own columns, in place of any of these names."""
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

    small_batches(docs.sparkSession)
    docs = docs.drop(*({"lang_pred", "score", "rejected"} - {text_column}))
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # a few hundred KB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(**sent.value)
        for batch in batches:
            texts = [lowered(t.as_py()) for t in batch.column(text_column)]
            letters = pa.compute.match_substring_regex(batch.column(text_column), r"\pL").fill_null(False)
            names, scores, far = [], [], []
            for part in pieces(texts):
                name, score, reject = known.predict(texts[part])
                names += name
                scores.append(score)
                far.append(reject)
            has = letters.to_numpy(zero_copy_only=False)
            score = np.where(has, np.concatenate(scores) if scores else np.zeros(0), 0.0)
            reject = np.where(has, np.concatenate(far) if far else np.zeros(0, dtype=bool), True)
            names = [n if h else UNKNOWN for n, h in zip(names, has, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(reject, pa.bool_())],
                names=[*batch.schema.names, "lang_pred", "score", "rejected"],
            )

    new = [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new]))


HELD_OUT = 2  # remainder of crc32(doc_id) by 4 that is never learned from


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs.where(has_learning_row("doc_id", 4, HELD_OUT)))
    held_out = ~has_learning_row("doc_id", 4, HELD_OUT)
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
