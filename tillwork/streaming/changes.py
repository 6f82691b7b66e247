"""Change capture on append-only tables, with a ledger of what refreshes counted and the audit log of their tasks.

The ledger has a row for each data file that a refresh has counted. A file that isn't in it is new; so nothing is counted
twice, whatever was interrupted, and whether anything is new is seen from file lists alone. Counts that no logged task
covers yet are open: the next refresh logs them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork.sources.files import listed_files, source_file
from tillwork.sources.tables import read_stored
from tillwork.streaming.ingest import drain

# --- fixed values: captured tables by refresh task, in the order of the tasks, and the audit names -----------------
TASKS = {
    "refresh_sales_task": ("store_sales", "web_sales", "catalog_sales"),
    "refresh_returns_task": ("store_returns", "web_returns"),
    "refresh_inventory_task": ("inventory",),
    "refresh_clickstream_task": ("raw_clickstream",),
}
ROOT_TASK = "root_refresh_task"
LAST_TASK = "log_completion_task — pipeline complete"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
CAPTURED = tuple(table for tables in TASKS.values() for table in tables)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("task_name", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("covers", T.ArrayType(T.StringType())),  # the runs whose counts the row reports
    ]
)
LEDGER = "table_name string, file string, n_rows bigint, run string, task string"

Tables = Mapping[str, tuple[str, T.StructType]]  # folder and schema by name


def append_log(
    spark: SparkSession,
    path: str,
    task: str,
    status: str,
    rows: int | None = None,
    error: str | None = None,
    run: str | None = None,
    covers: list[str] | None = None,
) -> None:
    """Adds one audit row. As in the runs it stands for, the end time stays open. With ``run``, the row replaces what an
    interrupted attempt of the same run wrote for the same task and status."""
    entry = spark.createDataFrame(
        [(task, rows, status, error, covers)],
        "task_name string, rows_processed bigint, status string, error_message string, covers array<string>",
    )
    shaped = entry.select(
        F.uuid().alias("run_id"),
        "task_name",
        F.current_timestamp().cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        "rows_processed",
        "status",
        "error_message",
        "covers",
    ).coalesce(1)
    if run is None:
        shaped.write.mode("append").parquet(f"{path}/run=none/task=none/state=none")
    else:
        number = [ROOT_TASK, *TASKS, LAST_TASK].index(task)
        shaped.write.mode("overwrite").parquet(f"{path}/run={run}/task={number}/state={status}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All audit rows, with the name of their run in ``run``."""
    schema = T.StructType([*RUN_LOG.fields, T.StructField("run", T.StringType())])
    return read_stored(spark, path, schema)


def new_rows(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the rows that are added to a folder.

    The folder must only ever be appended to; files that a rebuild replaces would count as new.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_stream(
    spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str, sink: Callable[[DataFrame, int], None]
) -> None:
    """Hands the rows added to a folder since the last call to ``sink``. The position moves only if it succeeds."""
    drain(new_rows(spark, folder, schema), checkpoint, sink)


def read_ledger(spark: SparkSession, state: str) -> DataFrame:
    return read_stored(spark, f"{state}/ledger", T.StructType.fromDDL(LEDGER))


def new_files(spark: SparkSession, tables: Tables, state: str) -> dict[str, list[str]]:
    """The files of each table that no refresh has counted: what is listed without what the ledger has. Contents are not
    read. Only names of new files come to the driver, as for any scan."""
    listed = []
    for table, (folder, _) in tables.items():
        listed.append(listed_files(spark, folder).select(F.lit(table).alias("table_name"), "file"))
    if not listed:
        return {}
    known = read_ledger(spark, state).select("table_name", "file")
    found = reduce(DataFrame.unionByName, listed).join(known, ["table_name", "file"], "left_anti")
    waiting: dict[str, list[str]] = {table: [] for table in tables}
    for row in found.collect():
        waiting[row["table_name"]].append(row["file"])
    return waiting


def count_files(spark: SparkSession, tables: Tables, waiting: Mapping[str, list[str]]) -> DataFrame:
    """(table_name, file, n_rows) of the given files. No column is read, so the counts come from file footers."""
    names = [(table, file) for table, files in waiting.items() for file in files]
    parts = [spark.createDataFrame(pa.table({"table_name": [t for t, _ in names], "file": [f for _, f in names]}))]
    parts[0] = parts[0].withColumn("n", F.lit(0))  # files without rows count as well
    for table, files in waiting.items():
        if files:
            read = spark.read.schema(tables[table][1]).parquet(*files)
            parts.append(read.select(F.lit(table).alias("table_name"), source_file().alias("file"), F.lit(1).alias("n")))
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "file").agg(F.sum("n").alias("n_rows"))


def consume(spark: SparkSession, tables: Tables, waiting: Mapping[str, list[str]], state: str, run: str) -> None:
    """Enters the counts of new files into the ledger, under the run and the task of their table, in one file a task.
    Files that the ledger has are not new any more, so a repeated attempt adds only what an earlier one did not enter."""
    if any(waiting.values()):
        task = F.coalesce(*[F.when(F.col("table_name").isin(*names), F.lit(task)) for task, names in TASKS.items()])
        counted = count_files(spark, tables, waiting).withColumns({"run": F.lit(run), "task": task})
        counted.coalesce(1).write.mode("append").partitionBy("run", "task").parquet(f"{state}/ledger")


def open_counts(spark: SparkSession, state: str, log: str, run: str | None = None) -> DataFrame:
    """(run, task, table_name, n_rows): ledger entries that no SUCCESS row of the log covers, also of runs that failed
    or were lost between counting and logging. Rows of ``run`` itself, which it is about to replace, cover nothing."""
    covered = read_log(spark, log).where((F.col("status") == SUCCESS) & ~F.col("run").eqNullSafe(F.lit(run)))
    covered = covered.select(F.col("task_name").alias("task"), F.explode("covers").alias("run"))
    counted = read_ledger(spark, state).groupBy("run", "task", "table_name").agg(F.sum("n_rows").alias("n_rows"))
    return counted.join(covered, ["run", "task"], "left_anti")


def count_new_rows(spark: SparkSession, tables: Tables, state: str, run: str) -> DataFrame:
    """Counts what is new in each table, and enters it into the ledger under ``run``; (table_name, n_rows)."""
    consume(spark, tables, new_files(spark, tables, state), state, run)
    return read_ledger(spark, state).where(F.col("run") == run).groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))


def refresh_counts(counts: DataFrame) -> DataFrame:
    """New rows per refresh task; a task whose tables had none still shows 0."""
    spark = counts.sparkSession
    plan = spark.createDataFrame([(t, name) for t, names in TASKS.items() for name in names], "task_name string, t string")
    joined = plan.join(F.broadcast(counts), F.col("t") == F.col("table_name"), "left")  # a row for each captured table
    return joined.groupBy("task_name").agg(
        F.sum(F.coalesce("n_rows", F.lit(0).cast("bigint"))).alias("rows_processed")
    )


def has_data(spark: SparkSession, tables: Tables, state: str, log: str) -> bool:
    """Whether there is a file that was never counted, or a count that was never logged."""
    if any(new_files(spark, tables, state).values()):
        return True
    return not open_counts(spark, state, log).isEmpty()


def refresh(spark: SparkSession, tables: Tables, state: str, log: str, run: str) -> bool:
    """One refresh. Each task counts the new rows of its tables and is logged at once, with all counts of the task that
    are still open. Nothing new, nothing logged.

    A failing task leaves a FAILED row with its message and is raised again; what earlier tasks counted is logged
    already, and later tasks find their files still new. A run that was lost between counting and logging leaves open
    counts, which the next one logs. ``run`` names the refresh; a repeated attempt under the same name replaces its rows.
    """
    step = ROOT_TASK
    try:
        if not has_data(spark, tables, state, log):
            return False
        append_log(spark, log, ROOT_TASK, RUNNING, run=run)
        for step, names in TASKS.items():
            own = {t: tables[t] for t in names if t in tables}
            consume(spark, own, new_files(spark, own, state), state, run)
            left = open_counts(spark, state, log, run).where(F.col("task") == step).groupBy("run").agg(F.sum("n_rows").alias("n"))
            left = left.collect()  # a row for each run that was interrupted, and this one
            covers = sorted({run, *[row["run"] for row in left]})
            append_log(spark, log, step, SUCCESS, sum(row["n"] for row in left), run=run, covers=covers)
        step = LAST_TASK
        append_log(spark, log, LAST_TASK, SUCCESS, run=run)
    except Exception as problem:
        append_log(spark, log, step, FAILED, error=str(problem), run=run)
        raise
    return True
