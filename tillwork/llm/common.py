"""What the corpus operators share: reading tables, settling plans in the shared folder, links to classes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.session import shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


ARROW_ROWS = 500  # rows that a Python worker gets at a time


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of few rows: Spark's default of 10,000 would keep tens of MB for each task,
    several times over, and hundreds where texts are long. The setting stays for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back: what follows survives lost executors and never runs
    the plan behind ``df`` again."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, name: str = "rid") -> DataFrame:
    """A gapless key for every row, also where ids repeat or are null: the rows of all files that come before by path,
    and the row's place in its own file. It depends on the files alone, so it is the same in every job, however a scan
    is split, whatever the number of cores and whichever executors were lost. A frame that isn't a plain read of
    Parquet files is written first; then the key holds for the frame that is returned."""
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    try:
        df.select(path, place)
    except AnalysisException:
        df = settle(df, "keyed-rows")
    own = df.select(path.alias("_path")).groupBy("_path").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)  # over one row a file
    files = own.select("_path", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    files = F.broadcast(settle(files, "file-offsets"))  # one row a file
    keyed = df.withColumns({"_own_path": path, "_place": place}).join(files, F.col("_own_path") == F.col("_path"))
    return keyed.withColumn(name, F.col("_before") + F.col("_place")).drop("_own_path", "_path", "_place", "_before")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, after which the Python worker gives free memory back: workers live on between tasks
    and stages, and what they keep without need would add to the memory of the next stage."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # not every C library has it
                trim(0)

    return whole


def has_learning_row(id_column: str, buckets: int, held_out: int):
    """True for rows that may be learned from: crc32 of the id as text, modulo ``buckets``, differs from ``held_out``."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % buckets != held_out


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups out of batches that are sorted by ``keys``: each table holds one or more complete groups."""
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        last = now.num_rows - 1
        differs = np.zeros(now.num_rows, dtype=bool)
        for key in keys:
            column = now.column(key).combine_chunks()
            differs |= column.to_numpy(zero_copy_only=False) != column[last].as_py()
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if waiting and cut == 0:
            same = all(waiting[-1].column(k)[-1].as_py() == now.column(k)[0].as_py() for k in keys)
            if not same:
                yield pa.concat_tables(waiting)
                waiting = []
            waiting.append(now)
            continue
        if cut:
            yield pa.concat_tables([*waiting, now.slice(0, cut)])
            waiting = [now.slice(cut)]
        else:
            waiting.append(now)
    if waiting:
        yield pa.concat_tables(waiting)


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, with the length at the end."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(1, dtype=np.int64)
    new = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return np.concatenate(([0], np.flatnonzero(new) + 1, [n]))


LINKS_A_FILE = 500_000


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for all nodes of the undirected ``links`` (a, b); a component is named by its smallest node.

    Alternates two steps until nothing changes. First every node hands the smallest node it knows to its larger
    neighbours, then to its smaller ones. Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain. A node with very many neighbours costs one partial aggregation and a join that
    adaptive execution may split. Rounds are written in files of up to LINKS_A_FILE links, so that few links don't cost
    a task for every shuffle partition each time."""
    edges = settle(links.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), purpose)
    before = link_sums(edges)
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").selectExpr("b as a", "m as b").where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("b as a", "m as b").where("a <> b")
        step = small.union(least.selectExpr("a", "m as b")).distinct()
        files = max(links.sparkSession.sparkContext.defaultParallelism, -(-before[0] // LINKS_A_FILE))
        after = settle(step.coalesce(files), purpose)
        now = link_sums(after)
        if now == before:
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        edges, before = after, now


def link_sums(df: DataFrame) -> tuple:
    """A count and sums of hashes, by which two sets of links are told apart."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(df.agg(F.count("*"), F.sum(h), F.bit_xor(F.xxhash64("b", "a"))).first())
