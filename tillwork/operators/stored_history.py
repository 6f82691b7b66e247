"""Type 2 history kept in files: open versions in buckets by key, closed ones written once, a log that names the newest load."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from tillwork.operators.history import KEY, TRACKED, VALID_TO, first_history, merge_open
from tillwork.sources.tables import read_stored

LOG = StructType(
    [StructField("load", IntegerType()), StructField("as_of", TimestampNTZType()), StructField("buckets", IntegerType()),
     StructField("columns", StringType())]
)


class LateLoad(ValueError):
    """A load that is older than what the history already holds."""


class StoredHistory:
    """A history below ``root``, which grows by one folder a load.

    ``data/load=N`` holds the versions that are open after load N (``state=open``) and those that load N closed
    (``state=closed``), both in buckets by key. The history after load N is the open versions of N and the closed ones of
    all loads up to N, so a load reads and writes open versions only, and closed ones are never touched again. Open
    versions are read bucket by bucket: only the incoming rows are shuffled.

    ``log/load=N`` is written when the data of load N are whole; it is the pointer to the newest load. A load that is lost
    before leaves no entry and is written anew by the next run. A load of an instant that the log holds is done already
    and changes nothing."""

    def __init__(self, spark: SparkSession, root: str, key: str = KEY, tracked: Sequence[str] = TRACKED, buckets: int | None = None):
        self.spark, self.root, self.key, self.tracked = spark, root.rstrip("/"), key, tuple(tracked)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[int, str] = {}

    def log(self) -> DataFrame:
        """The finished loads."""
        return read_stored(self.spark, f"{self.root}/log", LOG)

    def newest(self):
        """The entry of the newest finished load, None before the first one."""
        return self.log().orderBy(F.col("load").desc()).first()

    def load(self, incoming: DataFrame, as_of: dt.datetime) -> int:
        """Merges one load and returns its number."""
        before = self.newest()
        if before and before["as_of"] == as_of:
            return before["load"]
        if before and before["as_of"] > as_of:
            raise LateLoad(f"{as_of} is older than the newest load, {before['as_of']}")
        number = before["load"] + 1 if before else 1
        buckets = before["buckets"] if before else self.buckets
        merged = self.merged(incoming, as_of)
        state = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema.fields)
        self._write(merged.withColumn("state", state), number, buckets)
        entry = self.spark.createDataFrame([(number, as_of, buckets, columns)], LOG)
        entry.drop("load").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/log/load={number}")
        return number

    def merged(self, incoming: DataFrame, as_of: dt.datetime) -> DataFrame:
        """What a load writes: versions that stay open, versions that it closes, and versions that it opens."""
        before = self.newest()
        if not before:
            return first_history(incoming, as_of, self.key).repartition(self.buckets, self.key)
        # As many partitions as the open versions have buckets, so only the incoming rows move.
        rows = incoming.repartition(before["buckets"], self.key)
        return merge_open(self._open(before), rows, as_of, self.key, self.tracked)

    def read(self, number: int | None = None) -> DataFrame:
        """The whole history after a load, by default the newest one. Folders of other open versions are not read."""
        entry = self.newest() if number is None else self.log().where(F.col("load") == number).first()
        if entry is None:
            raise LookupError(f"No finished load {number or ''} in {self.root}")
        return self.spark.sql(self._query(entry))

    def publish(self, view: str) -> None:
        """Moves a catalog view, which other sessions see, to the newest load in one statement."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {self._query(self.newest())}")

    def _query(self, entry) -> str:
        names = ", ".join(f"`{name}`" for name in StructType.fromDDL(entry["columns"]).names)
        number = entry["load"]
        return (
            f"SELECT {names} FROM parquet.`{self.root}/data` "
            f"WHERE (load = {number} AND state = 'open') OR (load <= {number} AND state = 'closed')"
        )

    def _write(self, versions: DataFrame, number: int, buckets: int) -> None:
        name = self._name(number)
        written = versions.write.mode("overwrite").format("parquet").partitionBy("state").bucketBy(buckets, self.key)
        written.sortBy(self.key).option("path", f"{self.root}/data/load={number}").saveAsTable(name)
        if number - 2 in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(number - 2)}")  # the entry only, files stay

    def _open(self, entry) -> DataFrame:
        """The open versions of a load as a bucketed table, which is declared anew where another session wrote it."""
        number = entry["load"]
        if number not in self._tables:
            name = self._name(number)
            self.spark.sql(
                f"CREATE TABLE {name} ({entry['columns']}, state string) USING parquet PARTITIONED BY (state) "
                f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {entry['buckets']} BUCKETS "
                f"LOCATION '{self.root}/data/load={number}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return self.spark.table(self._tables[number]).where("state = 'open'").drop("state")

    def _name(self, number: int) -> str:
        return self._tables.setdefault(number, f"history_load_{number}_{uuid.uuid4().hex}")

