"""Ranked lexical search: the best documents for each of many items, by impact vectors in order of their length.

Term impacts of a document are integers that saturate with the term's frequency and shrink with the document's length.
An item's score of a document is the inner product of its term weights with the document's impacts. The search looks at
documents in buckets of falling vector length: Cauchy-Schwarz drops whole buckets, bounds on single coordinates drop
documents inside a bucket, and what is left is scored in integers."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.common import settle, small_batches, table

BEST = 50
ITEM_BYTES = 8 * 1024**2  # of the items that are searched for at a time, or one item if it is longer
PIECE = 1_000_000  # bytes of a text that are split into terms at a time
CHUNK = 16_384  # documents that a task holds at a time
CHUNK_TERMS = 4_000_000  # or as many impacts
BUCKET = 1_024  # documents of nearly equal vector length
SCALE, SATURATION, LENGTH_SHARE = 1_000_000_000, 20, 50
LADDER = (1, 4, 16)  # ranks whose scores a task reports for the first thresholds, besides the last rank asked for
ROUNDING = 1 + 1e-9  # bounds in doubles are widened by this


def _term_bytes() -> bytes:
    """Letters in lower case, digits and bytes beyond ASCII stay; all else is a blank."""
    shown = bytearray(b" " * 256)
    for i in (*range(48, 58), *range(97, 123), *range(128, 256)):
        shown[i] = i
    for i in range(65, 91):
        shown[i] = i + 32
    return bytes(shown)


TERM_BYTES = _term_bytes()


def term_counts(text: str | None) -> Counter[bytes]:
    data = (text or "").encode("utf-8").translate(TERM_BYTES)
    if len(data) <= PIECE:
        return Counter(data.split())
    counts: Counter[bytes] = Counter()
    start = 0
    while start < len(data):
        end = len(data) if start + PIECE >= len(data) else data.rfind(b" ", start, start + PIECE) + 1
        if end <= start:  # one term longer than a piece
            end = data.find(b" ", start + PIECE) + 1 or len(data)
        counts.update(data[start:end].split())
        start = end
    return counts


class Queries:
    """The terms of a block of items: ``terms`` numbered in byte order, and each item's term numbers in a row."""

    def __init__(self, items: list[tuple[int, str | None]]):
        own = [sorted(term_counts(text)) for _, text in items]
        self.keys = np.array([key for key, _ in items], dtype=np.int64)
        self.terms = {t: i for i, t in enumerate(sorted({t for terms in own for t in terms}))}
        self.rows = [np.array([self.terms[t] for t in terms], dtype=np.int64) for terms in own]


def impacts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's impact in a document, as 64-bit integers: rises with its frequency, falls with the document's length."""
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * n_docs) // n_terms
    return (SCALE * tf) // (1000 * tf + SATURATION * norm)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Bucketed:
    """Impact vectors of some documents, longest first, cut into buckets with their postings and largest impacts."""

    def __init__(self, start: np.ndarray, terms: np.ndarray, impact: np.ndarray, weights: np.ndarray):
        """``start`` has where each document's terms begin, with the end last."""
        doc = np.repeat(np.arange(len(start) - 1), np.diff(start))
        square = np.bincount(doc, weights[terms] * impact.astype(float) ** 2, minlength=len(start) - 1)
        self.order = np.argsort(-square, kind="stable")  # place -> document
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(place))
        self.square = square[self.order]
        self.size = len(place)
        by_place = np.argsort(place[doc], kind="stable")
        self.terms, self.impact = terms[by_place], impact[by_place]
        self.start = np.concatenate(([0], np.cumsum(np.diff(start)[self.order])))
        # Postings by bucket and term.
        self.buckets = -(-self.size // BUCKET)
        spots = np.repeat(np.arange(self.size), np.diff(self.start))
        cell = spots // BUCKET * len(weights) + self.terms
        by_cell = np.argsort(cell, kind="stable")
        self.spots, self.posted = spots[by_cell], self.impact[by_cell]
        first = np.flatnonzero(np.diff(cell[by_cell], prepend=-1))
        self.cells = cell[by_cell][first]
        self.cell_start = np.concatenate((first, [len(cell)]))
        self.largest = np.zeros((self.buckets, len(weights)), dtype=np.int64)
        if len(first):
            self.largest.reshape(-1)[self.cells] = np.maximum.reduceat(self.posted, first)

    def postings(self, bucket: int, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the postings of ``terms`` in a bucket, and which of the terms each belongs to."""
        wanted = bucket * width + terms
        at = np.searchsorted(self.cells, wanted)
        there = at < len(self.cells)
        there[there] = self.cells[at[there]] == wanted[there]
        which, at = np.flatnonzero(there), at[there]
        counts = self.cell_start[at + 1] - self.cell_start[at]
        return runs(self.cell_start[at], counts), np.repeat(which, counts)

    def scores(self, places: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact scores of documents, which hold at least one term each; ``dense`` has the item's weight of each term."""
        counts = self.start[places + 1] - self.start[places]
        flat = runs(self.start[places], counts)
        return np.add.reduceat(dense[self.terms[flat]] * self.impact[flat], np.cumsum(counts) - counts)


def runs(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (counts[0] numbers), first[1], ..."""
    before = np.cumsum(counts) - counts
    return np.repeat(first - before, counts) + np.arange(counts.sum())


def search(
    vectors: Bucketed, rows: list[np.ndarray], weights: np.ndarray, floors: np.ndarray, best: int, buckets: int | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, places, scores) of all documents that may be among an item's ``best``: none whose score is below the
    item's floor or below ``best`` other documents. Looks at the first ``buckets`` only if they are given."""
    width = len(weights)
    dense = np.zeros(width, dtype=np.int64)
    for item, terms in enumerate(rows):
        own = weights[terms]
        order = np.argsort(-own, kind="stable")
        terms, own = terms[order], own[order]  # heaviest first
        length = math.sqrt(own.sum())
        floor = max(1, int(floors[item]))
        dense[terms] = own
        found_places, found_scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        caps = vectors.largest[:, terms] * own  # most that each coordinate can add in each bucket
        for bucket in range(vectors.buckets if buckets is None else min(buckets, vectors.buckets)):
            longest = math.sqrt(vectors.square[bucket * BUCKET])
            if length * longest * ROUNDING < floor:
                break  # Cauchy-Schwarz: neither here nor in any shorter bucket
            rest = np.cumsum(caps[bucket][::-1])[::-1]  # what the coordinates from each on can add
            if not len(rest) or rest[0] < floor:
                continue
            focus = int(np.count_nonzero(rest >= floor))  # a document without any of these can't reach the floor
            at, which = vectors.postings(bucket, terms[:focus], width)
            spots = vectors.spots[at] - bucket * BUCKET
            count = min(BUCKET, vectors.size - bucket * BUCKET)
            gained = np.bincount(spots, own[which] * vectors.posted[at].astype(float), minlength=count)
            if focus < len(terms):
                used = np.bincount(spots, own[which] * vectors.posted[at].astype(float) ** 2, minlength=count)
                left = np.sqrt(np.maximum(vectors.square[bucket * BUCKET : bucket * BUCKET + count] - used, 0) + 1)
                more = np.minimum(left * math.sqrt(own[focus:].sum()), rest[focus])
            else:
                more = 0
            may = np.flatnonzero((gained > 0) & ((gained + more) * ROUNDING >= floor))
            if not len(may):
                continue
            places = may + bucket * BUCKET
            scores = vectors.scores(places, dense)
            reached = scores >= floor
            found_places.append(places[reached])
            found_scores.append(scores[reached])
            together = np.concatenate(found_scores)
            if len(together) >= best:
                floor = max(floor, int(np.partition(together, -best)[-best]))
        dense[terms] = 0
        places, scores = np.concatenate(found_places), np.concatenate(found_scores)
        yield item, places[scores >= floor], scores[scores >= floor]


def vectors_of(docs: DataFrame, terms: dict[bytes, int], id_column: str, text_column: str) -> DataFrame:
    """(doc_id, length, terms, tf) of every text: how many terms it has, and the numbers and frequencies of those that
    stand in ``terms``. One pass without a shuffle."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = source.schema["doc_id"].dataType
    schema = pa.schema(
        [("doc_id", to_arrow_type(kind)), ("length", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))]
    )
    known = spark.sparkContext.broadcast(terms)  # of one block of items, so no more than ITEM_BYTES or one item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for batch in batches:
            length, own_terms, own_tf = [], [], []
            for text in batch.column(1):
                counts = term_counts(text.as_py())
                hits = sorted((numbers[t], n) for t, n in counts.items() if t in numbers)
                length.append(counts.total())
                own_terms.append([t for t, _ in hits])
                own_tf.append([n for _, n in hits])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, f.type) for c, f in zip((length, own_terms, own_tf), list(schema)[1:])]],
                schema=schema,
            )

    return source.mapInArrow(run, f"doc_id {kind.simpleString()}, length long, terms array<int>, tf array<int>")


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Vectors that hold a known term, in tables of bounded rows and impacts."""
    waiting: list[pa.RecordBatch] = []
    rows = held = 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
        if not batch.num_rows:
            continue
        own = pc.sum(pc.list_value_length(batch.column("terms"))).as_py()
        if waiting and (rows + batch.num_rows > CHUNK or held + own > CHUNK_TERMS):
            yield pa.Table.from_batches(waiting)
            waiting, rows, held = [], 0, 0
        waiting.append(batch)
        rows, held = rows + batch.num_rows, held + own
    if waiting:
        yield pa.Table.from_batches(waiting)


def bucketed(chunk: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int) -> Bucketed:
    chunk = chunk.combine_chunks()
    lists = chunk.column("terms").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    terms = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    tf = pc.list_flatten(chunk.column("tf").combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.repeat(chunk.column("length").to_numpy(), sizes)
    start = np.concatenate(([0], np.cumsum(sizes)))
    return Bucketed(start, terms, impacts(tf, length, n_docs, n_terms), weights)


def keep_best(found: pa.Table, best: int) -> pa.Table:
    """The ``best`` rows of each item, by score and then by doc_id with nulls first."""
    keys = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
    found = found.take(pc.sort_indices(found, keys, null_placement="at_start"))
    items = found.column("item").to_numpy()
    nth = np.arange(len(items)) - np.searchsorted(items, items)
    return found.filter(pa.array(nth < best))


def first_floors(vectors: DataFrame, queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, best: int) -> np.ndarray:
    """For each item a score that at least ``best`` documents reach, 0 if none is found. Tasks look at the longest
    vectors of each chunk and report what some ranks reach; these counts add up over tasks."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries.rows, weights))
    ranks = sorted({r for r in LADDER if r < best} | {best})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, own_weights = shared.value
        top = np.zeros((len(rows), best), dtype=np.int64)
        for chunk in chunks(batches):
            found = bucketed(chunk, own_weights, n_docs, n_terms)
            for item, _, scores in search(found, rows, own_weights, top[:, 0], best, buckets=1):
                top[item] = np.sort(np.concatenate((top[item], scores)))[-best:]
        for rank, more in zip(ranks, np.diff([0, *ranks]), strict=True):
            some = np.flatnonzero(top[:, best - rank])
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(top[some, best - rank]), pa.array(np.full(len(some), more, dtype=np.int64))],
                names=["item", "score", "n"],
            )

    reached = vectors.mapInArrow(run, "item long, score long, n long").groupBy("item", "score").agg(F.sum("n").alias("n"))
    falling = Window.partitionBy("item").orderBy(F.col("score").desc())
    enough = reached.withColumn("n", F.sum("n").over(falling)).where(F.col("n") >= best)
    floors = np.zeros(len(queries.rows), dtype=np.int64)
    for row in enough.groupBy("item").agg(F.max("score").alias("score")).collect():  # a number for each item of a block
        floors[row["item"]] = row["score"]
    return floors


def search_block(docs: DataFrame, items: DataFrame, best: int, id_column: str, text_column: str) -> DataFrame:
    """(item, doc_id, score): for each item (item, text) of one block what may be among its ``best``."""
    queries = Queries([(row["item"], row["text"]) for row in items.collect()])  # ITEM_BYTES, or one item
    vectors = settle(vectors_of(docs, queries.terms, id_column, text_column), "ranking-vectors")
    counted = vectors.where("length > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("all")).first()
    n_docs, n_terms = counted["n"], counted["all"]
    weights = np.full(len(queries.terms), weight(0, n_docs), dtype=np.int64)
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for row in held.collect():  # a number for each term of a block of items
        weights[row["term"]] = weight(row["df"], n_docs)
    floors = first_floors(vectors, queries, weights, n_docs, n_terms, best)
    shared = docs.sparkSession.sparkContext.broadcast((queries.rows, queries.keys, weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, own_weights, floor = shared.value
        floor, kept = floor.copy(), None
        for chunk in chunks(batches):
            found = bucketed(chunk, own_weights, n_docs, n_terms)
            parts = list(search(found, rows, own_weights, floor, best))
            places = np.concatenate([p for _, p, _ in parts])
            if not len(places):
                continue
            new = pa.table(
                {
                    "item": np.repeat([i for i, _, _ in parts], [len(p) for _, p, _ in parts]),
                    "doc_id": chunk.column("doc_id").take(pa.array(found.order[places])),
                    "score": np.concatenate([s for _, _, s in parts]),
                }
            )
            kept = keep_best(new if kept is None else pa.concat_tables([kept, new]), best)
            items_kept, scores = kept.column("item").to_numpy(), kept.column("score").to_numpy()
            last = np.flatnonzero(np.diff(items_kept, append=-1))  # an item's last row is its lowest score
            full = np.bincount(items_kept, minlength=len(rows))[items_kept[last]] == best
            floor[items_kept[last][full]] = np.maximum(floor[items_kept[last][full]], scores[last][full])
        if kept is not None:
            named = pa.array(keys[kept.column("item").to_numpy()])
            yield from kept.set_column(0, "item", named).combine_chunks().to_batches()

    kind = vectors.schema["doc_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"item long, doc_id {kind}, score long")


def rank(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of each item with a score above 0, equal scores in the
    order of doc_id with nulls first.

    Items are taken in blocks of about ITEM_BYTES, each a query set against all documents: one pass makes a sparse
    vector of every text, which is stored; corpus counts come from all vectors; a first look at the longest vectors of
    each chunk gives every item a floor; the search proper passes over all vectors with these floors, and a task hands
    on no more than ``best`` documents of an item. Nothing is grouped by a key but these, so no key is hot.

    Null and empty texts have no terms, count for nothing and are never found; items without a term find nothing.
    Repeated documents are each ranked; repeated items each get their rows. Empty tables give no rows. Only the named
    columns and the items' ``text`` are read."""
    spark = docs.sparkSession
    listed = items.select(F.col(item_column).alias("item_id"), F.col("text").alias("text"))
    listed = settle(listed.withColumn("item", F.monotonically_increasing_id()), "ranking-items")  # numbers are data now
    size = listed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()["size"]
    n_blocks = max(1, -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = None
    for number in range(n_blocks):
        part = search_block(docs, listed.where(block == number).select("item", "text"), best, id_column, text_column)
        found = part if found is None else found.unionByName(part)
    falling = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    ranked = found.withColumn("rank", F.row_number().over(falling)).where(F.col("rank") <= best)
    names = listed.select("item", "item_id")
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = f"""
with words as (
  select doc_id, row_number() over () as k,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents where text is not null),
totals as (select count(*) as n_docs, sum(len(terms)) as n_terms from words where len(terms) > 0),
spread as (select k, unnest(terms) as term from words),
freq as (select k, term, count(*) as tf from spread group by k, term),
held as (select term, count(*) as df from freq group by term),
wanted as (
  select distinct item, item_id, term from (
    select row_number() over () as item, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from benchmark where text is not null)),
scored as (
  select item, item_id, k, doc_id, sum(
    cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1))) as bigint)
    * (({SCALE}::bigint * tf) // (1000 * tf + {SATURATION} * (100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * len(terms) * n_docs) // n_terms)))
  )::bigint as score
  from wanted join freq using (term) join held using (term) join words using (k) cross join totals
  group by item, item_id, k, doc_id),
ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls first) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {BEST}
"""
