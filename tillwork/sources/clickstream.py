"""Clickstream files: newline-delimited JSON in and out, and the typed landing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwork import functions as fn

# --- fixed values: fields of an event and the types of the landing table ------------------------------------------
EVENT_FIELDS = {
    "session_id": "string",
    "user_id": "bigint",
    "item_id": "bigint",
    "event_type": "string",
    "event_timestamp": "timestamp_ntz",
    "device_type": "string",
    "referrer_source": "string",
}
REQUIRED_FIELDS = ("session_id", "event_type", "event_timestamp")
BROKEN_LINE = "_corrupt_record"

# All fields are read as text: a wrong type must not lose the rest of the event.
TEXT_EVENT = T.StructType([T.StructField(name, T.StringType()) for name in (*EVENT_FIELDS, BROKEN_LINE)])


def clean_text(events: DataFrame) -> DataFrame:
    """The texts 'null', 'NULL' and '' become NULL in every field."""
    return events.withColumns({name: fn.null_tokens_to_null(F.col(name)) for name in EVENT_FIELDS})


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line, as text fields; a line that is no JSON keeps its text in ``_corrupt_record``."""
    return clean_text(spark.read.schema(TEXT_EVENT).json(path))


def stream_ndjson(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same for a folder in which files keep arriving."""
    return clean_text(spark.readStream.schema(TEXT_EVENT).options(**options).json(path))


def decode_json(raw: DataFrame, column: str = "value") -> DataFrame:
    """Text fields from a column that holds one JSON object per row."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN_LINE}
    parsed = raw.select(F.from_json(F.col(column).cast("string"), TEXT_EVENT, options).alias("event"))
    return clean_text(parsed.select("event.*"))


def _typed(name: str) -> Column:
    raw = F.col(name)
    if EVENT_FIELDS[name] == "bigint":
        return raw.try_cast("decimal(38,0)").try_cast("bigint")
    return raw.try_cast(EVENT_FIELDS[name])


def _accepted() -> Column:
    present = [F.col(f"typed.{name}").isNotNull() for name in REQUIRED_FIELDS]
    castable = [F.col(name).isNull() | F.col(f"typed.{name}").isNotNull() for name in EVENT_FIELDS]
    rule = F.lit(True)
    for test in (*present, *castable):
        rule = rule & test
    return rule


def parse_clickstream(text: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Text events to rows of the landing table. Works on streams too. See ``rejected_clickstream`` for the others."""
    typed = text.withColumn("typed", F.struct(*[_typed(name).alias(name) for name in EVENT_FIELDS]))
    at = F.current_timestamp().cast("timestamp_ntz") if ingested_at is None else ingested_at
    return typed.where(_accepted()).select("typed.*", at.alias("_ingested_at"))


def rejected_clickstream(text: DataFrame) -> DataFrame:
    """Text events that the landing table cannot take: no JSON, a required field missing, or a failing cast."""
    typed = text.withColumn("typed", F.struct(*[_typed(name).alias(name) for name in EVENT_FIELDS]))
    return typed.where(~_accepted()).drop("typed")


REJECTED = TEXT_EVENT


def judged_clickstream(text: DataFrame, *carried: str) -> DataFrame:
    """All text events in one pass: ``accepted`` tells which rows the landing table takes; those have its columns, the
    others their text fields in ``rejected``. ``carried`` columns go along."""
    typed = text.withColumn("typed", F.struct(*[_typed(name).alias(name) for name in EVENT_FIELDS]))
    judged = typed.withColumn("accepted", _accepted())
    taken = F.col("accepted")
    return judged.select(
        *[F.when(taken, F.col(f"typed.{name}")).alias(name) for name in EVENT_FIELDS],
        F.when(taken, F.current_timestamp().cast("timestamp_ntz")).alias("_ingested_at"),
        F.when(~taken, F.struct(*TEXT_EVENT.names)).alias("rejected"),
        *carried,
        "accepted",
    )


def as_json(events: DataFrame) -> DataFrame:
    """One JSON text per event, without NULL fields."""
    return events.select(F.to_json(F.struct(*EVENT_FIELDS)).alias("value"))


def write_ndjson(events: DataFrame, folder: str, batch: str) -> str:
    """Writes a batch as gzip files below its own subfolder; a repeated batch replaces itself."""
    target = f"{folder.rstrip('/')}/clickstream_batch_{batch}"
    as_json(events).write.mode("overwrite").text(target, compression="gzip")
    return target


def as_messages(events: DataFrame) -> DataFrame:
    """Key and value of a message per event; keyed by session, so that a session stays in order."""
    return events.select(F.col("session_id").alias("key"), F.to_json(F.struct(*EVENT_FIELDS)).alias("value"))
