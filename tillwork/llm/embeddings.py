"""Near-duplicate vectors by lattice hashing: random projections decoded to E8, neighbouring cells probed."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import components, grouped, settle, starts_of, table, with_row_key

COSINE = 0.98
PROBES = 6  # lattice cells that a vector stands in, in each table


@dataclass(frozen=True)
class Level:
    """How a label is hashed: independent projections, and the scale of a projected unit vector's coordinates in units of
    the lattice. ``most`` is the number of vectors of a label up to which the level serves."""

    most: float
    tables: int
    scale: float


# More vectors of a label get finer cells, and more tables to keep recall. Measured at 64 and 768 dimensions: of pairs at
# cosine 0.98 these find 1.0000, 0.9998 and 0.9995 at least; unrelated pairs share a cell with a chance of 4e-4, 9e-5 and
# 3e-5, so a vector meets some 8, 18 and, per million vectors of its label, 30 unrelated ones at most.
LEVELS = (Level(20_000, 6, 1.4), Level(200_000, 10, 1.9), Level(float("inf"), 16, 2.3))
FULL_CELL = 1024  # vectors of a cell that are compared as one block; larger cells are cut into blocks
PAIRS = 200_000  # compared at a time in a task


def e8_points(x: np.ndarray) -> np.ndarray:
    """The PROBES nearest E8 points found for each row of eight coordinates, nearest first, as twice the coordinates.

    E8 is the points with all-integer or all-half-integer coordinates and an even sum. For both kinds the nearest point
    is the rounded one, with the coordinate of the largest rounding error turned over where the sum is odd. Flipping
    further pairs of coordinates with large errors gives the neighbours."""
    found, far = [], []
    for offset in (0.0, 0.5):
        near = np.rint(x - offset)
        error = x - offset - near
        step = np.where(error >= 0, 1.0, -1.0)
        order = np.argsort(-np.abs(error), axis=1, kind="stable")
        odd = (near.sum(axis=1) % 2) != 0
        rows = np.arange(len(x))
        # sets of coordinates, by rank of their error, that are turned over: odd sums need odd sets
        for even_set, odd_set in (((), (0,)), ((0, 1), (1,)), ((0, 2), (2,)), ((1, 2), (3,)), ((0, 3), (0, 1, 2)), ((1, 3), (4,))):
            point = near.copy()
            for chosen, mask in ((even_set, ~odd), (odd_set, odd)):
                for rank in chosen:
                    at = order[:, rank]
                    point[rows, at] += np.where(mask, step[rows, at], 0)
            point += offset
            found.append(np.rint(2 * point))
            far.append(((x - point) ** 2).sum(axis=1))
    best = np.argsort(np.array(far), axis=0, kind="stable")[:PROBES]
    return np.array(found)[best, np.arange(len(x))].transpose(1, 0, 2)


def projections(dimensions: int, level: Level) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8)
    return rng.standard_normal((level.tables, dimensions, 8)) * level.scale, rng.random((level.tables, 8))


def lattice_cells(units: np.ndarray, level: Level) -> np.ndarray:
    """(rows, tables, PROBES) cell numbers of unit vectors."""
    matrices, shifts = projections(units.shape[1], level)
    mix = np.random.default_rng(80).integers(1, 1 << 62, 8, dtype=np.int64) | 1
    cells = []
    for t in range(level.tables):
        points = e8_points(units @ matrices[t] + shifts[t]).astype(np.int64)
        with np.errstate(over="ignore"):
            cells.append((points * mix).sum(axis=2) * np.int64(2 * t + 3))
    return np.stack(cells, axis=1)


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(rows.flatten(), dtype=np.float64).reshape(len(rows), -1)


def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of each vector, table by table."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            lengths, levels = np.diff(part.column(2).offsets.to_numpy()), part.column(3).to_numpy()
            for dimensions, nth in np.unique(np.stack((lengths, levels)), axis=1).T.tolist():
                own = part.filter(pa.array((lengths == dimensions) & (levels == nth)))
                values, level = as_matrix(own.column(2)), LEVELS[nth]
                cells = lattice_cells(values / np.linalg.norm(values, axis=1, keepdims=True), level)
                every = pa.FixedSizeListArray.from_arrays(pa.array(cells.reshape(-1)), level.tables * PROBES)
                yield pa.RecordBatch.from_arrays([*own.columns[:2], every.cast(pa.list_(pa.int64()))], names=["cls", "label", "cells"])


def padded_cells(column: pa.Array) -> np.ndarray:
    """(rows, tables, PROBES) cells; labels of fewer tables are filled up with numbers that no two rows share."""
    width = np.diff(column.offsets.to_numpy())
    cells = np.repeat((np.iinfo(np.int64).max - np.arange(len(column)))[:, None], width.max(), axis=1)
    cells[np.arange(width.max()) < width[:, None]] = np.asarray(column.flatten())
    return cells.reshape(len(column), -1, PROBES)


def index_pairs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows inside the runs that ``starts`` bound, at most about PAIRS at a time."""
    first = np.arange(starts[-1])
    ends = np.repeat(starts[1:], np.diff(starts))
    n = ends - first - 1
    upto = np.cumsum(n)
    begin = 0
    while begin < len(n):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, side="right")))
        some = n[begin:end]
        left = np.repeat(first[begin:end], some)
        right = left + 1 + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield left, right
        begin = end


def compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside cells, counted for each vector, and links that span what hangs together.

    A pair of vectors may share several cells; it counts in the first table where it shares one, in the smallest cell
    it shares there. Of the links of a cell only a spanning part is handed on, so rows stay in proportion to vectors."""
    keys = ["label", "tab", "cell", "left_block", "right_block"]
    for part in grouped(batches, keys):
        column = {name: part.column(name).combine_chunks() for name in part.schema.names}
        key = [column[k].to_numpy(zero_copy_only=False) for k in keys]
        lengths = np.diff(column["embedding"].offsets.to_numpy())
        starts = starts_of(*key)
        tab, cell, block = key[1], key[2], column["block"].to_numpy()
        cls, copies = column["cls"].to_numpy(), column["n"].to_numpy()
        width = int(lengths.max())
        values = np.zeros((len(cls), width))
        values[np.arange(width) < lengths[:, None]] = np.asarray(column["embedding"].flatten(), dtype=np.float64)
        values /= np.linalg.norm(values, axis=1, keepdims=True)
        cells = padded_cells(column["cells"])
        links: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for left, right in index_pairs(starts):
            # two blocks of a large cell meet pair by pair, a block with itself once
            own = (key[3][left] == key[4][left]) | (block[left] != block[right])
            left, right = left[own], right[own]
            near = np.einsum("ij,ij->i", values[left], values[right]) >= COSINE
            left, right = left[near], right[near]
            same_length = lengths[left] == lengths[right]
            left, right = left[same_length], right[same_length]
            if not len(left):
                continue
            shared = (cells[left][:, :, :, None] == cells[right][:, :, None, :]).any(axis=3)  # pairs, tables, cells
            table_of = shared.any(axis=2).argmax(axis=1)
            here = table_of == tab[left]
            first = np.where(shared, cells[left], np.iinfo(np.int64).max)[np.arange(len(left)), tab[left]].min(axis=1)
            here &= first == cell[left]
            for a, b in zip(left[here].tolist(), right[here].tolist(), strict=True):
                x, y = int(cls[a]), int(cls[b])
                links[x] = links.get(x, 0) + int(copies[b])
                links[y] = links.get(y, 0) + int(copies[a])
                p, q = root(x), root(y)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    edges.append((x, y))
        if links:
            yield pa.RecordBatch.from_arrays(
                [pa.array([*links, *[a for a, _ in edges]], pa.int64()), pa.array([*links.values(), *[0] * len(edges)], pa.int64()),
                 pa.array([*[None] * len(links), *[b for _, b in edges]], pa.int64())], names=["cls", "n_links", "other"]
            )


def link_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: links to rows of the same label with cosine COSINE or more.

    Equal vectors of a label become one class with a number of copies, so a vector that is repeated very often costs no
    more than its partial counts. Each class stands in PROBES cells of each table of its label (``LEVELS``). Classes are compared in
    double precision wherever they share a cell; large cells are cut into blocks, and every two blocks of a cell meet in
    a task of their own.

    Vectors that are null, empty, zero, or hold null or non-finite components, and rows without a label, link with
    nothing; nor do vectors of different lengths. A row whose id is null links like others and is named by no component;
    rows with equal ids are rows of their own. Only vectors that share a cell are moved there. An empty table gives no rows; other columns are not read."""
    rows = with_row_key(vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"), F.col(label_column).alias("label")))
    fit = (
        "label is not null and embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or"
        " abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)"
    )
    rows = rows.withColumn("fit", F.expr(f"coalesce({fit}, false)"))
    usable = rows.where("fit").select("rid", "vec_id", F.col("label").cast("string").alias("label"), "embedding")
    own = ["label", "embedding"]
    classes = settle(
        usable.groupBy(*own).agg(F.min("rid").alias("cls"), F.min("vec_id").alias("least"), F.count("*").alias("n")), "vector-classes"
    )
    sizes = classes.groupBy("label").agg(F.count("*").alias("n"))
    steps = reduce(lambda rest, nth: F.when(F.col("n") <= LEVELS[nth].most, nth).otherwise(rest), range(len(LEVELS) - 2, -1, -1), F.lit(len(LEVELS) - 1))
    levels = sizes.select("label", steps.alias("level"))
    cells = settle(classes.select("cls", "label", "embedding").join(levels, "label").select("cls", "label", "embedding", "level").mapInArrow(cells_of, "cls long, label string, cells array<long>"), "vector-cells")
    places = cells.select("cls", "label", F.posexplode("cells").alias("nth", "cell")).withColumn("tab", F.expr(f"int(nth div {PROBES})")).drop("nth")
    size = places.groupBy("label", "tab", "cell").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.expr(f"int(ceil(size / {FULL_CELL}D))").alias("blocks")
    shared = places.join(size, ["label", "tab", "cell"]).groupBy("cls").agg(  # at most tables * PROBES places
        F.collect_list(F.struct("tab", "cell", blocks)).alias("places")
    )
    placed = classes.join(shared, "cls").join(cells.select("cls", "cells"), "cls")
    placed = placed.select("cls", "label", "n", "embedding", "cells", F.explode("places").alias("place")).select("*", "place.*")
    placed = placed.withColumn("block", F.expr("int(pmod(xxhash64(cls), blocks))"))
    met = placed.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "label", "tab", "cell", "block", "cls", "n", "embedding", "cells",
        F.least("block", "with").alias("left_block"), F.greatest("block", "with").alias("right_block"),
    )
    keys = ["label", "tab", "cell", "left_block", "right_block"]
    found = settle(
        met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare_cells, "cls long, n_links long, other long"),
        "vector-links",
    )
    links = found.where("other is null").groupBy("cls").agg(F.sum("n_links").alias("more"))
    member = components(found.where("other is not null").selectExpr("cls as a", "other as b"), "vector-components")
    joined = classes.select("cls", *own, "n", "least").join(links, "cls", "left").join(member, F.col("cls") == F.col("node"), "left")
    joined = joined.withColumn("component", F.coalesce("component", "cls")).drop("node")
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = joined.join(names, "component").select(
        *[F.col(c).alias(f"c_{c}") for c in own], (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = usable.join(of_class, (F.col("label") == F.col("c_label")) & (F.col("embedding") == F.col("c_embedding")))
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(table(spark, folder, "embeddings"))
