"""The raw layer: twelve copied tables plus the landed clickstream."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.operators import keys

# --- fixed values: raw tables ---------------------------------------------------------------------------------
BRONZE_TABLES = (
    "store_sales",
    "web_sales",
    "catalog_sales",
    "store_returns",
    "web_returns",
    "inventory",
    "item",
    "customer",
    "customer_address",
    "date_dim",
    "promotion",
    "store",
)

RAW_CLICKSTREAM = T.StructType(
    [
        T.StructField("session_id", T.StringType(), False),
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("device_type", T.StringType()),
        T.StructField("referrer_source", T.StringType()),
        T.StructField("_ingested_at", T.TimestampNTZType()),
    ]
)


class ParquetTables(Mapping):
    """Tables below one folder, opened on first use so that a model only lists the files it needs."""

    def __init__(self, spark: SparkSession, root: str, names: Iterable[str], summaries: bool = False):
        self._spark, self._root, self._names, self._summaries = spark, root.rstrip("/"), tuple(names), summaries
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._root}/{name}")
        return self._open[name]

    def hot_keys(self, name: str) -> DataFrame | None:
        """Hashes of the hot keys ``name`` by the summaries that are stored beside the tables, None without any."""
        tables = [t for t in keys.KEYS[name] if t in self._names]
        if not self._summaries or not tables:
            return None
        return keys.hot_keys(keys.read_summaries(self._spark, self._root, name, tables))

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


def read_bronze(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = (*BRONZE_TABLES, "raw_clickstream"),
    summaries: bool = False,
) -> ParquetTables:
    """Tables below ``root``; with ``summaries``, also the key summaries that ``copy_bronze`` stores there."""
    return ParquetTables(spark, root, names, summaries)


def copy_bronze(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, names: Iterable[str] = BRONZE_TABLES
) -> ParquetTables:
    """Copy raw tables unchanged, and store summaries of their most frequent keys beside the copies, from which later
    plans learn without a job which keys are hot. A rerun replaces all of it, so it is safe to repeat."""
    names = tuple(names)
    for name in names:
        tables[name].write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    copied = read_bronze(spark, root, names, summaries=True)
    keys.store_summaries(spark, copied, root)
    return copied


def contents(df: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_values, digest): what each column holds, whatever the order of rows, and what the rows
    hold as a whole in the column ``*``. One pass; equal multisets of values have equal digests."""
    def summed(*columns: str) -> Column:
        hashed = F.xxhash64(*columns)
        return F.concat_ws("/", F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(F.lit(1), *columns)))

    parts = {**{c: (F.count(c), summed(c)) for c in df.columns}, "*": (F.count("*"), summed(*df.columns))}
    sums = df.agg(
        F.count("*").alias("n_rows"),
        *[F.struct(n.alias("n_values"), digest.alias("digest")).alias(f"_{i}") for i, (n, digest) in enumerate(parts.values())],
    )
    listed = [F.struct(F.lit(c).alias("column_name"), "n_rows", f"_{i}.n_values", f"_{i}.digest") for i, c in enumerate(parts)]
    return sums.select(F.inline(F.array(*listed)))


def compare_contents(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column_name, n_rows, n_values, same) of ``after``: whether each column, and the rows as a whole, hold what they
    held before."""
    old = contents(before).select("column_name", *[F.col(c).alias(f"old_{c}") for c in ("n_rows", "n_values", "digest")])
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in ("n_rows", "n_values", "digest")])
    both = contents(after).join(old, "column_name", "full")  # a row for each column
    return both.select("column_name", "n_rows", "n_values", equal.alias("same"))
