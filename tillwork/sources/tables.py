"""Written marts and the views that serve them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class SchemaDrift(ValueError):
    """A mart no longer has the columns that its view was declared with."""


def read_stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table whose folders may carry some of its columns; without rows before the first write."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_mart(df: DataFrame, path: str, cluster_by: Sequence[str], partitions: int | None = None) -> None:
    """Full rebuild, clustered so that filters on the leading columns skip row groups.

    Ranges are cut over all given columns; ending with a fine one lets a frequent leading value span many files.
    """
    ranged = df.repartitionByRange(partitions, *cluster_by) if partitions else df.repartitionByRange(*cluster_by)
    ranged.sortWithinPartitions(*cluster_by).write.mode("overwrite").parquet(path)


def without_drift(spark: SparkSession, name: str, path: str, expected: DataFrame | None = None) -> DataFrame:
    """A written mart, if it has the columns and types that its view was declared with."""
    stored = spark.read.parquet(path)
    if expected is not None:
        want = [(f.name, f.dataType) for f in expected.schema.fields]
        have = [(f.name, f.dataType) for f in stored.schema.fields]
        if want != have:
            raise SchemaDrift(f"{name}: declared {want}, stored {have}")
    return stored


def serving_view(spark: SparkSession, name: str, path: str, expected: DataFrame | None = None) -> DataFrame:
    """Points a view of this session at a written mart. Fails, and leaves the old view alone, when columns or types have
    changed."""
    without_drift(spark, name, path, expected).createOrReplaceTempView(name)
    return spark.table(name)


def publish_view(spark: SparkSession, name: str, path: str, expected: DataFrame | None = None) -> None:
    """The same as a catalog view, which other sessions see. One statement moves it from the folder of one run to that
    of the next; readers that have begun keep the files of theirs, as every run has a folder of its own."""
    without_drift(spark, name, path, expected)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def published_folder(spark: SparkSession, name: str) -> str | None:
    """The folder that a published view reads, None where there is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'View Text'").first()
    return found["data_type"].split("`")[1] if found else None
