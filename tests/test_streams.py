"""Replays of ingest and change capture over temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.operators.stored_history import StoredHistory
from tillwork.plans.layers import ALL_CHECKS, layered_run
from tillwork.plans.marts import CLUSTERED_BY
from tillwork.operators.quality import CheckFailed
from tillwork.sources import DerivedBronze, compare_contents
from tillwork.sources import clickstream as clicks
from tillwork.sources.tables import SchemaDrift, publish_view, published_folder, serving_view, write_mart
from tillwork.streaming import changes, ingest

GOOD = '{"session_id":"s1","user_id":"7","item_id":12,"event_type":"purchase","event_timestamp":"2024-01-01 10:00:00"}'
LINES = [
    GOOD,
    GOOD,  # delivered twice; staging keeps both
    '{"session_id":"s2","user_id":"null","item_id":"NULL","event_type":"page_view","event_timestamp":"2024-01-01T10:00:00","device_type":""}',
    '{"session_id":"s3","user_id":"seven","event_type":"page_view","event_timestamp":"2024-01-01 10:00:00"}',
    '{"session_id":"s4","event_type":"page_view","event_timestamp":"yesterday"}',
    '{"event_type":"page_view","event_timestamp":"2024-01-01 10:00:00"}',
    '{"session_id":"s5", broken',
]


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_ndjson_types_and_rejects(spark, tmp_path):
    land(tmp_path / "in", "a.ndjson", LINES)
    text = clicks.read_ndjson(spark, str(tmp_path / "in")).cache()
    taken = clicks.parse_clickstream(text)
    assert sorted((r.session_id, r.user_id, r.item_id, r.device_type) for r in taken.collect() if r.user_id is None) == [
        ("s2", None, None, None)
    ]
    assert taken.count() == 3
    rejected = clicks.rejected_clickstream(text)
    assert sorted(str(r.session_id) for r in rejected.collect() if r._corrupt_record is None) == ["None", "s3", "s4"]
    assert rejected.where(F.col("_corrupt_record").isNotNull()).count() == 1


def test_second_load_reads_only_the_new_file(spark, tmp_path):
    landing, table, position = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "position")
    land(landing, "a.ndjson", LINES)
    ingest.ingest_new(spark, str(landing), table, position)
    assert ingest.read_ingested(spark, table).count() == 3
    land(landing, "b.ndjson", [GOOD])
    ingest.ingest_new(spark, str(landing), table, position)
    ingest.ingest_new(spark, str(landing), table, position)
    assert sorted(r["count"] for r in ingest.read_batches(spark, table).groupBy("batch").count().collect()) == [1, 3]


def test_failed_write_is_repeated_and_nothing_is_doubled(spark, tmp_path):
    landing, table, position = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "position")
    land(landing, "a.ndjson", [GOOD])

    def crash(batch, number):
        ingest.save_events(table, batch, number)
        raise RuntimeError("lost after the write")

    stream = ingest.stream_landing(spark, str(landing))
    with pytest.raises(Exception, match="lost after the write"):
        ingest.drain(stream, position, crash)
    ingest.ingest_new(spark, str(landing), table, position)
    assert ingest.read_ingested(spark, table).count() == 1


def test_long_running_query_flushes_by_time(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "table")
    land(landing, "a.ndjson", [GOOD])
    stream = clicks.stream_ndjson(spark, str(landing), maxFilesPerTrigger=1)
    query = ingest.start_micro_batches(stream, table, str(tmp_path / "position"), "0", seconds=1)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert ingest.read_ingested(spark, table).count() == 1


def test_replay_under_a_new_checkpoint_replaces(spark, tmp_path):
    """Old files that are gone keep the rows of the load that read them; all others count once, by the newest load."""
    landing, table = tmp_path / "a b+c", str(tmp_path / "table")
    for name, lines in (("a.ndjson", LINES), ("b.ndjson", [GOOD]), ("c.ndjson", [GOOD, "{broken"])):
        land(landing, name, lines)
        ingest.ingest_new(spark, str(landing), table, str(tmp_path / "one"))
    (landing / "b.ndjson").rename(tmp_path / "kept.ndjson")
    land(landing, "d.ndjson", [GOOD])
    ingest.ingest_new(spark, str(landing), table, str(tmp_path / "two"))
    assert ingest.read_ingested(spark, table).count() == 3 + 1 + 1 + 1
    assert ingest.read_rejects(spark, table).count() == 4 + 1
    assert ingest.waiting_files(spark, str(landing), table).count() == 0
    loads = ingest.read_batches(spark, table).select("load").distinct().count()
    assert loads == 2 and ingest.read_manifest(spark, table).count() == 4


def test_an_attempt_that_was_not_entered_is_invisible(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "table")
    land(landing, "a.ndjson", [GOOD])
    ingest.ingest_new(spark, str(landing), table, str(tmp_path / "position"))
    taken = ingest.read_batches(spark, table).select("load").first()[0]
    spark.read.parquet(f"{table}/load={taken}/batch=0").write.partitionBy("accepted").parquet(f"{table}/load={taken}/batch=1")
    assert ingest.read_ingested(spark, table).count() == 1


def test_flush_by_size_or_age(spark, tmp_path):
    landing, place = tmp_path / "in", (str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "position"))
    landing.mkdir()
    assert not ingest.flush_when_due(spark, *place, enough_bytes=0, seconds=0)
    land(landing, "a.ndjson", [GOOD] * 10)
    size = (landing / "a.ndjson").stat().st_size
    assert not ingest.flush_when_due(spark, *place, enough_bytes=size + 1, seconds=3600)
    assert ingest.flush_when_due(spark, *place, enough_bytes=size, seconds=3600)
    land(landing, "b.ndjson", [GOOD])
    assert not ingest.flush_when_due(spark, *place, enough_bytes=size, seconds=3600)
    later = dt.datetime.now() + dt.timedelta(hours=2)
    assert ingest.flush_when_due(spark, *place, enough_bytes=size, seconds=3600, now=later)
    assert ingest.read_ingested(spark, place[1]).count() == 11


def test_rejects_stay_beside_the_table(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "table")
    land(landing, "a.ndjson", [GOOD, "{broken"])
    ingest.ingest_new(spark, str(landing), table, str(tmp_path / "position"))
    assert ingest.read_ingested(spark, table).count() == 1
    assert ingest.read_rejects(spark, table).count() == 1


def test_refresh_logs_counts_once(spark, tmp_path):
    schema = spark.range(1).schema
    tables = {name: (str(tmp_path / name), schema) for name in changes.CAPTURED}
    for n, (path, _) in enumerate(tables.values(), start=1):
        spark.range(n).write.parquet(path)
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    assert changes.refresh(spark, tables, state, log, "r1")
    assert not changes.refresh(spark, tables, state, log, "r2")
    rows = {r.task_name: (r.rows_processed, r.status) for r in changes.read_log(spark, log).collect()}
    assert rows == {
        changes.ROOT_TASK: (None, "RUNNING"),
        "refresh_sales_task": (6, "SUCCESS"),
        "refresh_returns_task": (9, "SUCCESS"),
        "refresh_inventory_task": (6, "SUCCESS"),
        "refresh_clickstream_task": (7, "SUCCESS"),
        changes.LAST_TASK: (None, "SUCCESS"),
    }


def test_counts_come_from_footers(spark, tmp_path):
    """The plan that counts new files reads no column, and files are new once."""
    path = str(tmp_path / "a table+x")
    tables = {"inventory": (path, spark.range(1).schema)}
    spark.range(50).repartition(3).write.parquet(path)
    waiting = changes.new_files(spark, tables, str(tmp_path / "state"))
    assert len(waiting["inventory"]) == 3
    counted = changes.count_files(spark, tables, waiting)
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.agg(F.sum("n_rows")).first()[0] == 50
    changes.consume(spark, tables, waiting, str(tmp_path / "state"), "r")
    spark.range(7).write.mode("append").parquet(path)
    assert len(changes.new_files(spark, tables, str(tmp_path / "state"))["inventory"]) >= 1
    found = changes.count_new_rows(spark, tables, str(tmp_path / "state"), "s").collect()
    assert [(r.table_name, r.n_rows) for r in found] == [("inventory", 7)]


def test_a_run_that_is_repeated_under_its_name_logs_once(spark, tmp_path, monkeypatch):
    tables = {name: (str(tmp_path / name), spark.range(1).schema) for name in changes.CAPTURED}
    for path, _ in tables.values():
        spark.range(4).write.parquet(path)
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    real = changes.append_log

    def lost(spark, path, task, status, *rest, **more):
        if task == "refresh_inventory_task" and status == changes.SUCCESS:
            raise KeyboardInterrupt  # as if the driver died after the counts were entered
        real(spark, path, task, status, *rest, **more)

    monkeypatch.setattr(changes, "append_log", lost)
    with pytest.raises(KeyboardInterrupt):
        changes.refresh(spark, tables, state, log, "r1")
    monkeypatch.setattr(changes, "append_log", real)
    assert changes.has_data(spark, tables, state, log)
    assert changes.refresh(spark, tables, state, log, "r1")
    rows = sorted((r.task_name, r.status, r.rows_processed) for r in changes.read_log(spark, log).collect() if r.rows_processed is not None)
    assert [(r[0], r[2]) for r in rows] == [
        ("refresh_clickstream_task", 4), ("refresh_inventory_task", 4), ("refresh_returns_task", 8), ("refresh_sales_task", 12),
    ]
    assert changes.open_counts(spark, state, log).isEmpty()
    assert not changes.refresh(spark, tables, state, log, "r2")


def test_serving_view_notices_drift(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.lit("a"))
    path = str(tmp_path / "mart")
    write_mart(df, path, ("id",), partitions=2)
    assert serving_view(spark, "mv_test", path, expected=df).count() == 5
    with pytest.raises(SchemaDrift):
        serving_view(spark, "mv_test", path, expected=df.withColumn("w", F.lit(1)))


def test_changed_contents_are_seen(spark, folder, tmp_path):
    """One changed value, one lost row or two swapped values turn a column or the rows red; order doesn't."""
    before = spark.createDataFrame([(1, "a", 1.5), (2, "b", None), (2, "b", None)], "k long, v string, x double")
    red = lambda after: {r.column_name for r in compare_contents(before, after).where("not same").collect()}
    assert red(before.orderBy(F.desc("k"))) == set()
    assert red(before.withColumn("v", F.expr("if(k = 1, 'c', v)"))) == {"v", "*"}
    assert red(before.limit(2)) == {"k", "v", "x", "*"}
    swapped = spark.createDataFrame([(1, "b", 1.5), (2, "a", None), (2, "b", None)], "k long, v string, x double")
    assert red(swapped) == {"*"}
    assert red(spark.createDataFrame([], before.schema)) == {"k", "v", "x", "*"}


def test_a_bad_copy_or_a_repeated_dimension_key_stops_the_run(spark, folder, tmp_path, monkeypatch):
    from tillwork.plans import layers

    options = {"as_of": dt.date(2002, 1, 1), "loaded_at": dt.datetime(2024, 1, 1), "must_pass": False}
    sources = dict(DerivedBronze(spark, folder).items())
    twice = {**sources, "item": sources["item"].unionByName(sources["item"].limit(1))}
    with pytest.raises(CheckFailed, match="Stopped at silver: unique.stg_item.item_id"):
        layered_run(spark, twice, str(tmp_path / "twice"), **options)
    assert not (tmp_path / "twice" / "gold").exists()
    real = layers.copy_bronze

    def losing(spark, sources, root, names):
        return real(spark, {**sources, "store": sources["store"].limit(3)}, root, names)

    monkeypatch.setattr(layers, "copy_bronze", losing)
    with pytest.raises(CheckFailed, match="Stopped at bronze: same_contents.store"):
        layered_run(spark, sources, str(tmp_path / "lost"), **options)


def test_published_views_move_and_are_seen_by_other_sessions(spark, tmp_path):
    first, second = str(tmp_path / "one/mart"), str(tmp_path / "two/mart")
    spark.range(5).write.parquet(first)
    spark.range(9).write.parquet(second)
    publish_view(spark, "mv_moving", first, expected=spark.range(1))
    other = spark.newSession()
    assert other.table("mv_moving").count() == 5 and published_folder(other, "mv_moving") == first
    begun = other.table("mv_moving")
    publish_view(spark, "mv_moving", second)
    assert other.table("mv_moving").count() == 9 and begun.count() == 5
    with pytest.raises(SchemaDrift):
        publish_view(spark, "mv_moving", first, expected=spark.range(1).withColumn("w", F.lit(1)))
    assert published_folder(spark, "mv_moving") == second and published_folder(spark, "mv_nowhere") is None
    spark.sql("drop view mv_moving")


def test_the_calendar_spans_the_files(spark, folder, tmp_path):
    """Sales outside the usual calendar keep their date."""
    for name in ("orders", "lineitem"):
        table = spark.read.parquet(f"{folder}/{name}.parquet")
        day = "o_orderdate" if name == "orders" else "l_shipdate"
        late = F.expr(f"if({name[0]}_orderkey % 10 = 3, {day} + interval 12 years, {day})")
        table.withColumn(day, late).write.parquet(str(tmp_path / f"{name}.parquet"))
    raw = DerivedBronze(spark, str(tmp_path))
    ends = raw["date_dim"].agg(F.min("d_date"), F.max("d_date"), F.count("*"), F.countDistinct("d_date")).first()
    assert ends[0] == dt.date(1990, 1, 1) and ends[1].year >= 2013 and (ends[1].month, ends[1].day) == (12, 31)
    assert ends[2] == ends[3] == (ends[1] - ends[0]).days + 1
    sold, days = raw["store_sales"], raw["date_dim"]
    assert sold.join(days, sold["ss_sold_date_sk"] == days["d_date_sk"], "left_anti").where("ss_sold_date_sk is not null").count() == 0


def test_layers_merge_into_a_stored_history(spark, folder, tmp_path):
    store = StoredHistory(spark, str(tmp_path / "history"), buckets=3)
    layered_run(
        spark, DerivedBronze(spark, folder), str(tmp_path / "run"), as_of=dt.date(2002, 1, 1), loaded_at=dt.datetime(2024, 1, 1),
        must_pass=False, stored_history=store,
    )
    assert store.newest() is None and not (tmp_path / "run/history").exists()
    layered_run(
        spark, DerivedBronze(spark, folder), str(tmp_path / "again"), as_of=dt.date(2002, 1, 1), loaded_at=dt.datetime(2024, 1, 1),
        tolerated=ALL_CHECKS, stored_history=store,
    )
    customers = DerivedBronze(spark, folder)["customer"].where("c_customer_sk is not null").count()
    assert store.newest()["load"] == 1 and store.read().where("dbt_valid_to is null").count() == customers


def test_layers_publish_only_what_passes(spark, folder, tmp_path):
    options = {"as_of": dt.date(2002, 1, 1), "loaded_at": dt.datetime(2024, 1, 1)}
    sources = DerivedBronze(spark, folder)
    with pytest.raises(CheckFailed, match="unique.mart_customer_ltv.customer_id"):
        layered_run(spark, sources, str(tmp_path / "one"), **options)
    failing = spark.read.parquet(str(tmp_path / "one/checks")).where("failures > 0")
    known = [r.check_name for r in failing.collect()]
    report = layered_run(
        spark, sources, str(tmp_path / "two"), tolerated=known,
        previous_history=str(tmp_path / "one/history/customer_snapshot"),
        fresh_as_of=dt.datetime(2024, 1, 1), **options,
    )
    assert report.count() == 69 + 13
    for mart in CLUSTERED_BY:
        assert not spark.table(mart.replace("mart_", "mv_")).isEmpty()
    history = spark.read.parquet(str(tmp_path / "two/history/customer_snapshot"))
    assert history.count() == spark.read.parquet(str(tmp_path / "one/history/customer_snapshot")).count()


def test_events_of_one_key_are_chosen_alike_in_any_order(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, 10)
    events = [("k", kind, item, at, at + dt.timedelta(hours=late)) for kind, item, late in
              (("purchase", 1, 1), ("add_to_cart", 2, 1), ("page_view", 3, 1), ("add_to_cart", 2, 2))]
    schema = "event_sk string, event_type string, item_id bigint, event_timestamp timestamp_ntz, _ingested_at timestamp_ntz"
    for name, order in (("up", events), ("down", events[::-1])):
        raw, out = str(tmp_path / name / "raw"), str(tmp_path / name / "out")
        for event in order:  # a file each, read one by one
            spark.createDataFrame([event], schema).coalesce(1).write.mode("append").parquet(raw)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(raw)
        writer = ingest.dedup_events(stream).writeStream.option("checkpointLocation", str(tmp_path / name / "position"))
        writer.trigger(availableNow=True).format("parquet").start(out).awaitTermination()
        stored = spark.read.parquet(out)
        assert sorted(r.event_type for r in stored.collect()) == ["add_to_cart", "page_view", "purchase"]
        assert [(r.event_type, r.item_id) for r in ingest.one_per_key(stored).collect()] == [("add_to_cart", 2)]
