"""Contiguous shards of nearly equal bytes, cut from a global prefix sum over sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.llm.common import settle, table

SHARDS = 24
OVERHEAD = 8  # bytes that a document needs besides its text


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, row, shard, slot) of every row, in the order of id, then checksum, then size.

    Rows are sorted by range, each range's bytes and rows are added up, and prefix sums over the few range totals give
    the bytes before each range; a running sum inside the range completes them. The middle of a row, as a share of all
    bytes, tells its shard, so shards are contiguous and none is further from its target than the largest row. Texts
    leave the plan before the first shuffle.

    Null texts count as empty; null ids come first; repeated rows are rows of their own; an empty table gives no rows.
    Only the two named columns are read."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = settle(ranged, "byte-shards")  # from here on a row's range is data, not a matter of the plan
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    before = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside))
        .withColumn("nth", F.count("*").over(inside))
        .join(F.broadcast(before), "part")  # one row a range
        .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("end", F.col("bytes_before") + F.col("upto"))
        .withColumn("shard", F.expr(f"int((2 * end - size) * {int(shards)} div (2 * all_bytes))"))
    )
    placed = placed.select("doc_id", "size", "text_crc32", "row", "shard")
    first = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    return placed.join(F.broadcast(first), "shard").select(  # one row a shard
        "doc_id", "size", "text_crc32", "row", "shard", (F.col("row") - F.col("first_row")).alias("slot")
    )


def op8_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = byte_shards(table(spark, folder, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
