"""Summaries of the most frequent keys of a table, stored beside it, from which plans learn what is hot without a job.

A summary is a sketch of bounded size that tasks fill and merge; summaries of several tables, or of loads that were
appended, merge the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators.lookup import INTEGERS

TRACKED = 10_000  # keys that a sketch holds
MOST = 1_000  # hot keys that are ever looked at

# --- fixed values: summaries by name, with the key columns in each raw table -------------------------------------------
KEYS = {
    "sale": {
        "store_sales": ("ss_ticket_number", "ss_item_sk"),
        "web_sales": ("ws_order_number", "ws_item_sk"),
        "catalog_sales": ("cs_order_number", "cs_item_sk"),
        "store_returns": ("sr_ticket_number", "sr_item_sk"),
        "web_returns": ("wr_order_number", "wr_item_sk"),
    },
    "customer": {
        "store_sales": ("ss_customer_sk",),
        "web_sales": ("ws_bill_customer_sk",),
        "catalog_sales": ("cs_bill_customer_sk",),
    },
    "item": {"inventory": ("inv_item_sk",)},
    "user": {"raw_clickstream": ("user_id",)},
}


def summarize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(n_rows, summary): one row about the keys of ``df``; rows without a key count for nothing."""
    kinds = dict(df.dtypes)
    key = F.xxhash64(*[F.col(c).cast("bigint") if kinds[c] in INTEGERS else F.col(c) for c in columns])
    keyed = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])).select(key.alias("key"))
    return keyed.agg(F.count("*").alias("n_rows"), F.expr(f"approx_top_k_accumulate(key, {TRACKED})").alias("summary"))


def store_summaries(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> None:
    """Writes the summaries of all raw tables that have one below ``root``, beside the tables."""
    for name, own in KEYS.items():
        for table, columns in own.items():
            if table in tables:
                summarize(tables[table], columns).write.mode("overwrite").parquet(_path(root, name, table))


def read_summaries(spark: SparkSession, root: str, name: str, tables: Sequence[str]) -> DataFrame:
    """The stored summaries of ``tables``; reading starts no job, as the schema is known."""
    schema = summarize(spark.range(0), ["id"]).schema
    return spark.read.schema(schema).parquet(*[_path(root, name, t) for t in tables])


def merged(summaries: DataFrame) -> DataFrame:
    return summaries.agg(F.sum("n_rows").alias("n_rows"), F.expr(f"approx_top_k_combine(summary, {TRACKED})").alias("summary"))


def frequent(summaries: DataFrame) -> DataFrame:
    """(key, n, n_rows): the MOST most frequent key hashes with estimates of their rows, and the rows with any key."""
    listed = merged(summaries).select("n_rows", F.explode(F.expr(f"approx_top_k_estimate(summary, {MOST})")).alias("top"))
    return listed.select(F.col("top.item").alias("key"), F.col("top.count").alias("n"), "n_rows")


def hot_keys(summaries: DataFrame, partitions: int | None = None) -> DataFrame:
    """(key): hashes of keys that alone have more rows than a mean partition, so at most as many as there are
    partitions, and at most MOST."""
    parts = partitions or int(summaries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frequent(summaries).where(F.col("n") * parts >= F.col("n_rows")).select("key")


def _path(root: str, name: str, table: str) -> str:
    return f"{root.rstrip('/')}/_key_summaries/{name}/{table}"
