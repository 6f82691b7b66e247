"""A whole run: copy raw tables, build and write the models, keep history, check, and publish what passes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.fixed_values import Thresholds
from tillwork.operators import history, quality
from tillwork.operators.stored_history import StoredHistory
from tillwork.plans.marts import CLUSTERED_BY
from tillwork.plans.warehouse import MART_NAMES, Warehouse
from tillwork.sources.bronze import compare_contents, copy_bronze
from tillwork.sources.tables import publish_view, serving_view, write_mart


ASSERTED = ("assert_net_revenue_not_negative", "assert_all_channels_present")
ALL_CHECKS = tuple(c.name for c in (*quality.STAGING_CHECKS, *quality.MART_CHECKS)) + ASSERTED


def view_name(mart: str) -> str:
    return mart.replace("mart_", "mv_", 1)


DIMENSION_KEYS = tuple(
    f"unique.{model}.{column}"
    for model, column in (
        ("stg_item", "item_id"),
        ("stg_customer", "customer_id"),
        ("stg_customer_address", "address_id"),
        ("stg_date_dim", "date_sk"),
        ("stg_promotion", "promotion_id"),
        ("stg_store", "store_id"),
    )
)


def _changed(table: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """One check of a copy: how many of its columns don't hold what they held in the source."""
    differing = compare_contents(before, after).agg(F.count_if(~F.col("same")).alias("failures"))
    return differing.select(F.lit(f"same_contents.{table}").alias("check_name"), "failures")


def _stop_if_failed(spark: SparkSession, root: str, layer: str, names: Iterable[str] | None = None) -> None:
    report = spark.read.parquet(f"{root}/checks/layer={layer}").where("failures > 0")
    if names is not None:
        report = report.where(F.col("check_name").isin(*names))
    failed = [f"{row['check_name']} ({row['failures']})" for row in report.collect()]  # one small row per check
    if failed:
        raise quality.CheckFailed(f"Stopped at {layer}: " + ", ".join(sorted(failed)))


def _report(layer: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(layer).alias("layer"), F.col("check_name"), F.col("failures"))


def layered_run(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    root: str,
    *,
    as_of: dt.date,
    loaded_at: dt.datetime,
    previous_history: str | None = None,
    fresh_as_of: dt.datetime | None = None,
    limits: Thresholds | None = None,
    tolerated: Iterable[str] = (),
    must_pass: bool = True,
    publish: bool = False,
    stored_history: StoredHistory | None = None,
) -> DataFrame:
    """Runs all layers into the new folder ``root`` and gives back the failures per check.

    Each run has its own folder, so a failed run leaves the published one untouched. The sales lines, which three
    marts read, are computed and stored once. Views move to this run only if no check outside ``tolerated`` fails;
    with ``must_pass`` such a failure is raised after everything was reported. ``fresh_as_of`` adds the age of the
    clickstream to the checks. With ``publish`` the views are those of the catalog, which other sessions see; else they
    are this session's.

    Two gates stop a run early, before costly work on bad ground: copied raw tables that don't hold what their sources
    held, and dimensions whose key repeats, which would multiply every row that looks them up.

    Customer history is written whole into ``root`` (``previous_history`` is the folder of the last run's), or, with a
    ``stored_history``, merged into that one after all checks (and published as ``customer_snapshot`` with ``publish``);
    it knows its newest load itself.
    """
    raw = copy_bronze(spark, sources, f"{root}/bronze", tuple(sources))
    copied = [_changed(table, sources[table], raw[table]) for table in raw]
    bronze = reduce(DataFrame.unionByName, copied)
    bronze.write.mode("overwrite").parquet(f"{root}/checks/layer=bronze")
    _stop_if_failed(spark, root, "bronze")
    house = Warehouse(raw, as_of=as_of, limits=limits)
    staged = {f"stg_{table.removeprefix('raw_')}": house.staged(table) for table in raw}
    silver = quality.run_checks(staged, quality.STAGING_CHECKS)
    if fresh_as_of:
        stale = quality.dq_freshness(raw["raw_clickstream"], "_ingested_at", fresh_as_of)
        count = F.when(F.col("status") == "error", 1).otherwise(0).cast("bigint")
        silver = silver.unionByName(
            stale.select(F.lit("freshness.raw_clickstream._ingested_at").alias("check_name"), count.alias("failures"))
        )
    _report("silver", silver).write.mode("overwrite").parquet(f"{root}/checks/layer=silver")
    _stop_if_failed(spark, root, "silver", DIMENSION_KEYS)

    house.mart_lines.write.mode("overwrite").parquet(f"{root}/intermediate/sales_lines")
    shared = Warehouse(raw, as_of=as_of, limits=limits, lines=spark.read.parquet(f"{root}/intermediate/sales_lines"))
    for name in MART_NAMES:
        write_mart(shared.mart(name), f"{root}/gold/{name}", CLUSTERED_BY[name])

    people = house.snapshot_input
    if not stored_history:
        if previous_history:
            merged = history.scd2_merge(spark.read.parquet(previous_history), people, loaded_at)
        else:
            merged = history.first_history(people, loaded_at)
        merged.write.mode("overwrite").parquet(f"{root}/history/customer_snapshot")

    marts = {name: spark.read.parquet(f"{root}/gold/{name}") for name in MART_NAMES}
    revenue = marts["mart_daily_revenue"]
    asserted = [
        quality.dq_net_revenue_not_negative(revenue).agg(F.count("*").alias("failures")).select(
            F.lit(ASSERTED[0]).alias("check_name"), "failures"
        ),
        quality.dq_all_channels_present(revenue).agg(F.count("*").alias("failures")).select(
            F.lit(ASSERTED[1]).alias("check_name"), "failures"
        ),
    ]
    gold = reduce(DataFrame.unionByName, [quality.run_checks(marts, quality.MART_CHECKS), *asserted])
    _report("gold", gold).write.mode("overwrite").parquet(f"{root}/checks/layer=gold")

    report = spark.read.parquet(f"{root}/checks").select("layer", "check_name", "failures")
    blocking = report.where((F.col("failures") > 0) & ~F.col("check_name").isin(*tolerated, ""))
    failed = [f"{row['check_name']} ({row['failures']})" for row in blocking.collect()]  # one small row per check
    if not failed:
        if stored_history:
            stored_history.load(people, loaded_at)
            if publish:
                stored_history.publish("customer_snapshot")
        show = publish_view if publish else serving_view
        for name in MART_NAMES:
            show(spark, view_name(name), f"{root}/gold/{name}", expected=shared.mart(name))
    elif must_pass:
        raise quality.CheckFailed("Not published: " + ", ".join(sorted(failed)))
    return report
