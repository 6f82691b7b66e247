"""Benchmark decontamination: every passage of every document is a BM25 query against an index of test items."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tillwork.llm.common import small_batches, table
from tillwork.llm.features import pieces

K1, B = 1.2, 0.75
SHORTEST = 64  # words of half a passage, for items up to that length; longer items get passages twice as long, and so on
BLOCK = 8  # test items of a block, whose highest impacts bound its scores
SCORE = 0.4  # of what the item itself would score; below OVERLAP, as the half that is verified may be the one of common words
GRAM = 5  # words of the n-grams that are verified
OVERLAP = 0.5  # of the n-grams of the question, and of the answer
NEARLY_ALL = 0.8  # of all n-grams, where one of the two parts is missing
SLICE_BYTES = 32_000_000  # of item texts that are broadcast at a time; more items take more passes

WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence of an item is its answer; an item of one sentence has none."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n", text) if WORDS.search(p)]
    return (words_of(text), []) if len(parts) < 2 else (words_of(" ".join(parts[:-1])), words_of(parts[-1]))


def tolerant_grams(words: list[str]) -> set[tuple[str, ...]]:
    """N-grams of up to a third of a short text, so that one other word does not change all of them."""
    n = max(1, min(GRAM, len(words) // 3))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


@dataclass(frozen=True)
class Statistics:
    """Of all test items that have words: their number, their words, and how many items hold each word asked for."""

    items: int
    words: int
    holding: dict[str, int]

    def idf(self, word: str) -> float:
        return math.log(1 + (self.items - self.holding[word] + 0.5) / (self.holding[word] + 0.5))


def statistics_of(texts: list[str]) -> Statistics:
    bags = [words_of(t) for t in texts]
    return Statistics(sum(map(bool, bags)), sum(map(len, bags)), Counter(w for b in bags for w in set(b)))


class BlockMaxIndex:
    """An inverted index of test items of similar length. Impacts are BM25 weights as a share of what the item scores
    itself, so one threshold holds for all items. Items stand in blocks; a term keeps the highest impact in each."""

    def __init__(self, items: list[tuple[int, str]], half: int, known: Statistics):
        self.half, self.ids, self.texts = half, [i for i, _ in items], [t for _, t in items]
        bags = [Counter(words_of(t)) for t in self.texts]
        self.terms = {t: n for n, t in enumerate(sorted({t for bag in bags for t in bag}))}
        mean = known.words / known.items
        idf = {t: known.idf(t) for t in self.terms}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for item, bag in enumerate(bags):
            norm = K1 * (1 - B + B * sum(bag.values()) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in bag.items()}
            total = sum(impact.values())
            for t, w in impact.items():
                postings[self.terms[t]].append((item, w / total))
        self.item_at = np.cumsum([0] + [len(p) for p in postings])
        self.item = np.array([i for p in postings for i, _ in p], dtype=np.int32)
        self.impact = np.array([w for p in postings for _, w in p])
        self.blocks = -(-len(items) // BLOCK)
        best = [{} for _ in postings]
        for t, p in enumerate(postings):
            for i, w in p:
                best[t][i // BLOCK] = max(w, best[t].get(i // BLOCK, 0))
        self.block_at = np.cumsum([0] + [len(b) for b in best])
        self.block = np.array([b for m in best for b in m], dtype=np.int64)
        self.block_max = np.array([w for m in best for w in m.values()])
        parts = [question_and_answer(t) for t in self.texts]
        self.question, self.answer = [grams(q) for q, _ in parts], [grams(a) for _, a in parts]
        self.short_answer = [tolerant_grams(a) for _, a in parts]

    def bounds(self, terms: np.ndarray, segment: np.ndarray, segments: int) -> np.ndarray:
        """For each segment and block the most that an item of the block can score with the segment's terms."""
        n = self.block_at[terms + 1] - self.block_at[terms]
        at = np.repeat(self.block_at[terms] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        cell = np.repeat(segment, n) * self.blocks + self.block[at]
        return np.bincount(cell, self.block_max[at], minlength=segments * self.blocks).reshape(segments, self.blocks)

    def scores(self, terms: np.ndarray, passage: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) where an item reaches the threshold, looked for in the ``allowed`` blocks only."""
        n = self.item_at[terms + 1] - self.item_at[terms]
        at = np.repeat(self.item_at[terms] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        passage, item = np.repeat(passage, n), self.item[at]
        inside = allowed[passage, item // BLOCK]
        cell = passage[inside] * len(self.ids) + item[inside]
        total = np.bincount(cell, self.impact[at[inside]], minlength=len(allowed) * len(self.ids))
        high = np.flatnonzero(total >= SCORE - 1e-9)
        return high // len(self.ids), high % len(self.ids), total[high]

    def search(self, texts: list[list[str]]) -> list[dict[int, tuple]]:
        """Of each text (words) the verified items: {item: (passages, score, question overlap, answer overlap)}.

        A passage is two halves of ``half`` words, the next one starts a half later, so an item of up to ``half`` words
        stands whole in one of them. Blocks whose bound stays below the threshold are skipped."""
        known, half = self.terms, self.half
        found: list[dict[int, tuple]] = [{} for _ in texts]
        counts = [max(1, -(-len(t) // half)) for t in texts]
        first = np.concatenate(([0], np.cumsum(counts)))
        term = np.array([known.get(w, -1) for t in texts for w in t], dtype=np.int64)
        lengths = np.array([len(t) for t in texts])
        inside = np.arange(len(term)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        segment = np.repeat(first[:-1], lengths) + inside // half
        keep = term >= 0
        if not keep.any():
            return found
        key = np.unique(segment[keep] * len(known) + term[keep])
        segment, term = key // len(known), key % len(known)
        bound = self.bounds(term, segment, int(first[-1]))
        window = bound.copy()
        window[:-1] += bound[1:]
        window[first[1:-1] - 1] = bound[first[1:-1] - 1]  # the last half of a text has no next one
        starts = np.searchsorted(segment, np.arange(first[-1] + 1))
        allowed = window >= SCORE - 1e-9
        chosen = np.flatnonzero(allowed.any(axis=1))
        if not len(chosen):
            return found
        text_of = np.searchsorted(first, chosen, side="right") - 1
        ends = np.minimum(chosen + 2, first[text_of + 1])
        n = starts[ends] - starts[chosen]
        at = np.repeat(starts[chosen] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        pair = np.unique(np.repeat(np.arange(len(chosen)), n) * len(known) + term[at])  # each term once a passage
        hits = self.scores(pair % len(known), pair // len(known), allowed[chosen])
        for p, item, score in zip(*(h.tolist() for h in hits), strict=True):
            text = int(text_of[p])
            own = int(chosen[p]) - int(first[text])
            passage = texts[text][own * half : (own + 2) * half]
            there = {n: {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)} for n in range(1, GRAM + 1)}
            q, a = self.question[item], self.answer[item]
            in_q = sum(g in there[len(g)] for g in q)
            in_a = sum(g in there[len(g)] for g in a)
            short = self.short_answer[item]
            over_q, over_a = in_q / len(q), sum(g in there[len(g)] for g in short) / len(short) if short else 1.0
            if min(over_q, over_a) >= OVERLAP or (in_q + in_a) / (len(q) + len(a)) >= NEARLY_ALL:
                count, *before = found[text].get(item, (0, 0.0, 0.0, 0.0))
                found[text][item] = (count + 1, *map(max, before, (score, over_q, over_a)))
        return found


def indexes(items: list[tuple[int, str]], known: Statistics) -> list[BlockMaxIndex]:
    """One index for each class of lengths, so that long items don't make the passages for short ones long. All weigh
    words by what is ``known`` of all items."""
    classes: dict[int, list[tuple[int, str]]] = {}
    for item, text in sorted(items):
        n = len(words_of(text))
        if n:
            half = SHORTEST
            while half < n:
                half *= 2
            classes.setdefault(half, []).append((item, text))
    return [BlockMaxIndex(members, half, known) for half, members in sorted(classes.items())]


def slices(items: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """The test items in slices of bounded bytes, each with the statistics of all items for the words of the slice."""
    rows = items.select(F.col(id_column).cast("long").alias("i"), F.col(text_column).alias("t")).where(
        "i is not null and t is not null"
    )
    rows = rows.groupBy("t").agg(F.min("i").alias("i"))  # equal items are one
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // SLICE_BYTES))
    for part in range(n):
        own = [(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("t"), F.lit(n)) == part).collect()]
        here = statistics_of([t for _, t in own])
        yield own, here if n == 1 else statistics_over(rows.select("t"), set(here.holding))


def statistics_over(texts: DataFrame, asked: set[str]) -> Statistics:
    """Of all ``texts``; one pass, which returns a row for each word asked for."""
    sent = texts.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = words = 0
        holding: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                own = words_of(text.as_py())
                items, words = items + bool(own), words + len(own)
                holding.update(sent.value.intersection(own))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *holding], pa.string()), pa.array([items, *holding.values()], pa.int64()),
             pa.array([words] + [0] * len(holding), pa.int64())], names=["w", "n", "m"],
        )

    sums = texts.mapInArrow(run, "w string, n long, m long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).collect()
    total = next(r for r in sums if r.w is None)
    return Statistics(total.n, total.m, {r.w: r.n for r in sums if r.w is not None})


HITS = ArrayType(
    StructType(
        [StructField("item_id", LongType()), StructField("passages", LongType()), StructField("score", DoubleType()),
         StructField("question_overlap", DoubleType()), StructField("answer_overlap", DoubleType())]
    )
)


def with_leaks(docs: DataFrame, items: DataFrame, text_column: str = "text", id_column: str = "item_id", item_text: str = "text", name: str = "leaks") -> DataFrame:
    """``docs`` with an array of the test items that each row holds.

    Null and empty texts hold none. Items that are null, or have no words, are never found; equal items count as one
    with the smallest id. Repeated rows are judged each for itself; empty tables give no rows or no hits."""
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches(docs.sparkSession)
    for part in slices(items, id_column, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(part)  # SLICE_BYTES at most
        last = name in docs.columns

        def run(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            known, kind = indexes(*sent.value), to_arrow_type(HITS)
            for batch in batches:
                raw = [t.as_py() or "" for t in batch.column(text_column)]
                hits: list[list[dict]] = batch.column(name).to_pylist() if last else [[] for _ in raw]
                for some in pieces(raw, 256):
                    words = [words_of(t) for t in raw[some]]
                    for index in known:
                        for row, found in enumerate(index.search(words), some.start):
                            hits[row] += [dict(zip(HITS_NAMES, (index.ids[i], *v), strict=True)) for i, v in found.items()]
                columns = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != name]
                names = [n for n in batch.schema.names if n != name]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(hits, kind)], names=[*names, name])

        fields = [f for f in docs.schema.fields if f.name != name]
        docs = docs.mapInArrow(run, StructType([*fields, StructField(name, HITS)]))
    return docs


HITS_NAMES = ("item_id", "passages", "score", "question_overlap", "answer_overlap")


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, passages, score, question_overlap, answer_overlap): a row for each document and test item that
    it holds. See ``with_leaks`` for odd rows."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text_column).alias("text"))
    held = with_leaks(source, items, "text", item_id, item_text).select("doc_id", F.explode("leaks").alias("hit"))
    return held.select("doc_id", "hit.*")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
