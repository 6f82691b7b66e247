"""Joins to dimensions and to other facts that stay healthy when one side is huge or one key is hot.

Three ways, from cheapest to most general:

* ``lookup`` broadcasts the dimension, but only after its inputs were measured and found small.
* Larger dimensions take Spark's shuffle join. It is asked for by name: files are packed, so a few MB of keys may be
  hundreds in a broadcast, which the driver holds as a whole.
* In that shuffle join, rows without a key never match, so they are spread instead of landing in one task; and keys
  that are known to be hot are salted. Both are exact: no row is dropped, capped or sampled.

*Which* keys are hot is handed in: as hashes, or as a frame of hashes from the key summaries that are stored with the
raw tables (``keys``). So no job runs while a plan is built, and a wrong hint costs time, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 * 1024**2  # most bytes that the inputs of a broadcast dimension may have; in memory it may take 20 times as much
SPREAD_BYTES = 16 * 1024**3  # facts below this size are joined without spreading

Hot = list[int] | DataFrame | None  # hashes of hot keys, or a frame of few of them in its only column ``key``


def input_bytes(df: DataFrame) -> int:
    """Bytes of all inputs that a frame is computed from, as known before it runs (file sizes for files).

    Summed over the leaves of the plan: Spark's estimate of a join multiplies its sides, which says nothing about
    key lookups. Inputs of unknown size count as very large there, so they are never taken for small.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return input_bytes(df) <= limit


def _matches(on: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(left) == F.col(right) for left, right in on.items()])


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    how: str = "left",
    *,
    spread_by: Sequence[str] = (),
    limit: int = BROADCAST_BYTES,
    hot: Hot = None,
) -> DataFrame:
    """Join ``facts`` to ``dim`` on ``{fact column: dimension column}``; fact and dimension column names must differ.

    ``spread_by`` names fact columns that vary between rows of one key; they are only read by a salted shuffle join.
    With a ``limit`` of 0 Spark chooses the join. ``dim`` should hold each key once (the quality checks test that); duplicates multiply rows as in any join.
    """
    if small(dim, limit):
        return facts.join(F.broadcast(dim), _matches(on), how)
    if limit:  # else the bytes of the inputs say nothing about the dimension, and Spark may choose
        dim = dim.hint("shuffle_merge")
    return spread_join(facts, dim, on, how, spread_by=spread_by, hot=hot)


def with_hot(df: DataFrame, columns: Sequence[str], hot: Hot, name: str) -> DataFrame:
    """Adds whether the key of a row is among the hot ones."""
    key = F.xxhash64(*[F.col(c).cast("bigint") if kind in INTEGERS else F.col(c) for c, kind in df.select(*columns).dtypes])
    if hot is None or isinstance(hot, list):
        return df.withColumn(name, key.isin(hot) if hot else F.lit(False))
    listed = F.broadcast(hot.select(F.col("key").alias("_hot_key")))  # no more than keys.MOST rows
    marked = df.withColumn("_own_key", key).join(listed, F.col("_own_key") == F.col("_hot_key"), "left")
    return marked.withColumn(name, F.col("_hot_key").isNotNull()).drop("_own_key", "_hot_key")


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def spread_join(
    facts: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    how: str = "left",
    *,
    spread_by: Sequence[str] = (),
    also: Column | None = None,
    hot: Hot = None,
    hot_on: Sequence[str] | None = None,
    ways: int | None = None,
) -> DataFrame:
    """Shuffle join in which rows without a key and rows of hot keys are spread over ``ways`` tasks.

    Fact rows of a hot key get one of ``ways`` salts, from a hash of ``spread_by``, and the matching dimension rows
    exist once per salt; all other rows have salt 0 on both sides. Facts below SPREAD_BYTES take the plain join.
    ``also`` is a further condition. ``hot_on`` names the fact columns that the hints are about, all of ``on`` by default.
    """
    if how not in ("left", "inner"):
        raise ValueError("spread_join keeps or filters fact rows: use left or inner")
    left_columns, right_columns = list(on), list(on.values())
    matches = _matches(on) if also is None else _matches(on) & also
    if not spread_by or input_bytes(facts) <= SPREAD_BYTES:
        return facts.join(dim, matches, how)
    ways = ways or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(ways)).cast("int")
    hinted = list(hot_on or left_columns)
    spread = with_hot(facts, hinted, hot, "_hot").withColumn(
        "_salt", F.when(_keyless(left_columns) | F.col("_hot"), salt).otherwise(0)
    )
    every_salt = F.sequence(F.lit(0), F.lit(ways - 1))
    salted_dim = with_hot(dim, [on[c] for c in hinted], hot, "_dim_hot").withColumn(
        "_dim_salt", F.explode(F.when(F.col("_dim_hot"), every_salt).otherwise(F.array(F.lit(0))))
    )
    salted = matches & (F.col("_salt") == F.col("_dim_salt"))
    return spread.join(salted_dim.drop("_dim_hot"), salted, how).drop("_hot", "_salt", "_dim_salt")


def _keyless(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def fanout_left_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    *,
    spread_left: Sequence[str],
    spread_right: Sequence[str],
    show: Sequence[str] | None = None,
    hot: Hot = None,
    hot_on: Sequence[str] | None = None,
    ways: int | None = None,
) -> DataFrame:
    """Left join in which a key may repeat on both sides, so that either side can be the heavy one. One pass over each.

    The pairs of a hot key are laid out on a grid of cells: each left row picks a grid row and goes to all its cells,
    each right row picks a grid column and goes to all its cells, so each pair meets exactly once and no task sees the
    whole key. All other rows have the cell 0 of their key, and left rows without a key are spread.

    A left row of a hot key meets no partner in some of its cells, though it has one elsewhere; so only its home cell
    may show it without partner, and only if the key has none at all. The keys that have one are counted from the very
    exchange that the join reads, not from another pass over ``right``. Hints may be wrong: a key that isn't hot, or has
    no partner, costs copies of its rows and nothing else.

    ``spread_left`` and ``spread_right`` name columns that vary between rows of one key. ``show`` are the columns of
    ``right`` that the caller goes on to use, all by default; the others stay behind, which also lets the exchange be
    read twice. ``hot_on`` names the columns of ``left`` that the hints are about, all of ``on`` by default. Facts below SPREAD_BYTES on both sides take the plain join, as do all without hints.
    """
    left_columns, right_columns = list(on), list(on.values())
    shown = list(dict.fromkeys([*right_columns, *(right.columns if show is None else show)]))
    if hot is None or hot == [] or max(input_bytes(left), input_bytes(right)) <= SPREAD_BYTES:
        return left.join(right.select(*shown), _matches(on), "left")
    tasks = ways or max(4, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edge = math.ceil(math.sqrt(tasks))

    row = F.pmod(F.xxhash64(*spread_left), F.lit(edge)).cast("int")
    own_row = F.sequence(1 + row * edge, (row + 1) * edge)
    alone = F.array(-1 - F.pmod(F.xxhash64(*spread_left), F.lit(tasks)).cast("int"))
    plain = F.array(F.lit(0))
    cells = F.when(_keyless(left_columns), alone).when(F.col("_hot"), own_row).otherwise(plain)
    hinted = list(hot_on or left_columns)
    placed = with_hot(left, hinted, hot, "_hot").withColumn("_cell", F.explode(cells)).drop("_hot")

    column = F.pmod(F.xxhash64(*spread_right), F.lit(edge)).cast("int")
    own_column = F.sequence(1 + column, 1 + column + edge * (edge - 1), F.lit(edge))
    met = with_hot(right, [on[c] for c in hinted], hot, "_dim_hot").where(~_keyless(right_columns))
    met = met.withColumn("_dim_cell", F.explode(F.when(F.col("_dim_hot"), own_column).otherwise(plain)))
    met = met.where("_dim_cell is not null").select(*shown, "_dim_cell").repartition(*right_columns, "_dim_cell")

    # Uses all columns, so that both readers of the exchange ask it for the same ones and it runs once.
    in_grid = [F.when(F.col("_dim_cell") > 0, F.col(c)).alias(f"_held_{i}") for i, c in enumerate(right_columns)]
    held = met.groupBy(*in_grid).agg(F.max(F.xxhash64(*met.columns)).alias("_held"))
    held = F.broadcast(held)  # no more rows than hints, and one of nulls for all other keys

    joined = placed.join(met, _matches(on) & (F.col("_cell") == F.col("_dim_cell")), "left")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_held_{i}")) for i, c in enumerate(left_columns)])
    home = (F.col("_cell") > 0) & (F.pmod(F.col("_cell") - 1, F.lit(edge)) == 0)
    joined = joined.join(held, same, "left").where(
        F.col("_dim_cell").isNotNull() | (F.col("_cell") <= 0) | (home & F.col("_held").isNull())
    )
    return joined.drop("_cell", "_dim_cell", "_held", *[f"_held_{i}" for i in range(len(on))])
