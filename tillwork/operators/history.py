"""Type 2 history of customers: a new version whenever the tracked address columns change."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.operators.lookup import Hot, lookup, with_hot

# --- fixed values: key and tracked columns of the customer history, and the names of the added columns -----------
KEY = "customer_id"
TRACKED = ("state_code", "zip_code", "city")
VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"


def snapshot_input(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customer with address, one row each; what the history is fed with."""
    places = addresses.select(
        F.col("address_id").alias("_address_id"), "address_code", "city", "state_code", "zip_code", "country", "region"
    )
    return lookup(customers, places, {"current_address_id": "_address_id"}).select(
        "customer_id",
        "customer_code",
        "first_name",
        "last_name",
        "email",
        "is_preferred_customer",
        "address_code",
        "city",
        "state_code",
        "zip_code",
        "country",
        "region",
    )


def _version_id(key: Column, at: Column) -> Column:
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (key, at)]
    return F.md5(F.concat_ws("|", *parts))


def _opened(rows: DataFrame, key: str, at: Column) -> DataFrame:
    return rows.withColumns(
        {
            VERSION_ID: _version_id(F.col(key), at),
            UPDATED_AT: at,
            VALID_FROM: at,
            VALID_TO: F.lit(None).cast("timestamp_ntz"),
        }
    )


def _instant(as_of: dt.datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def first_history(incoming: DataFrame, as_of: dt.datetime, key: str = KEY) -> DataFrame:
    return _opened(incoming, key, _instant(as_of))


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    as_of: dt.datetime,
    key: str = KEY,
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """The history after one load: changed and missing keys are closed, changed and new keys get an open version.

    Other columns may differ without a new version. NULL equals NULL. Only open versions are joined; closed ones pass
    through without a shuffle. Write the result to a new folder, never over the one that ``history`` reads.
    """
    closed = history.where(F.col(VALID_TO).isNotNull())
    return closed.unionByName(merge_open(history.where(F.col(VALID_TO).isNull()), incoming, as_of, key, tracked))


def merge_open(
    live: DataFrame, incoming: DataFrame, as_of: dt.datetime, key: str = KEY, tracked: Sequence[str] = TRACKED
) -> DataFrame:
    """What one load makes of the open versions ``live``: kept, closed and newly opened ones."""
    at = _instant(as_of)
    columns = incoming.columns
    # Keys are joined as plain columns, so that a side that is stored in buckets by key stays where it is.
    both = live.select(F.col(key).alias("_old_key"), F.struct(*live.columns).alias("old")).join(
        incoming.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("new")),
        F.col("_old_key") == F.col("_new_key"),
        "full",
    )
    was, now = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])
    unchanged = was & now & same
    # One pass over the join: each matched pair yields the kept or closed old row, the opened new row, or both.
    end = F.when(~unchanged, at)
    kept = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in (*columns, VERSION_ID, UPDATED_AT, VALID_FROM)],
        end.alias(VALID_TO),
    )
    opened = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in columns],
        _version_id(F.col(f"new.{key}"), at).alias(VERSION_ID),
        at.alias(UPDATED_AT),
        at.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )
    versions = F.filter(
        F.array(F.when(was, kept), F.when(now & ~unchanged, opened)), lambda version: version.isNotNull()
    )
    return both.select(F.inline(versions))


def scd2_current(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def scd2_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions that were valid at a moment; the end of a validity is exclusive."""
    ended = F.coalesce(F.col(VALID_TO) <= moment, F.lit(False))
    return history.where((F.col(VALID_FROM) <= moment) & ~ended)


def join_as_of(
    facts: DataFrame, history: DataFrame, key: str, moment: str, hot: Hot = None, ways: int | None = None
) -> DataFrame:
    """Facts with the version of their customer that was valid at the time of the fact, in columns ``as_of_*``.

    Facts and versions are put in one order of time per key, and each fact takes the last version before it, if that is
    still valid: one sort, linear also where a key has very many versions. The versions of a key don't overlap, as
    ``scd2_merge`` keeps them. Facts of hot keys are spread over ``ways`` groups, each with all versions of the key;
    facts without a key or a time have no version, and those without a key are spread.
    """
    ways = ways or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(moment, *facts.columns[:1]), F.lit(ways)).cast("int")
    own = with_hot(facts, [key], hot, "_hot").select(
        F.col(key).alias("_key"),
        F.when(F.col("_hot") | F.col(key).isNull(), salt).otherwise(0).alias("_group"),
        F.col(moment).alias("_time"),
        F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"),
    )
    version = F.struct(*[F.col(c).alias(f"as_of_{c}") for c in history.columns])
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    versions = with_hot(history.where(F.col(KEY).isNotNull()), [KEY], hot, "_hot").select(
        F.col(KEY).alias("_key"),
        F.explode(every).alias("_group"),
        F.col(VALID_FROM).alias("_time"),
        F.lit(0).alias("_kind"),
        version.alias("_version"),
    )
    so_far = Window.partitionBy("_key", "_group").orderBy("_time", "_kind", F.col(f"_version.as_of_{VALID_TO}").asc_nulls_last())
    before = F.last("_version", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = own.unionByName(versions, allowMissingColumns=True).withColumn("_last", before).where("_kind = 1")
    ended = F.col(f"_last.as_of_{VALID_TO}") <= F.col("_time")
    known = F.when(~F.coalesce(ended, F.lit(False)), F.col("_last"))
    return both.withColumn("_last", known).select("_fact.*", "_last.*")
