"""Names of the files that rows come from, and lists of the files in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def source_file() -> Column:
    """The file of a row, spelled as ``listed_files`` does. Only for frames that read files."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def listed_files(spark: SparkSession, folder: str, below: bool = False) -> DataFrame:
    """(file, length, modified) of the files in a folder, with ``below`` also in its subfolders; empty ones are left
    out. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(below).lower()).load(folder)
    return files.where("length > 0").select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
