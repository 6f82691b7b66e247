"""Properties of plans that matter for large inputs."""

import datetime as dt
import re

import pytest

from tillwork.operators import lookup
from tillwork.plans import catalog
from tillwork.plans.warehouse import MART_NAMES, Warehouse
from tillwork.sources import DerivedBronze, compare_contents, copy_bronze, derived


@pytest.fixture(scope="module")
def house(spark, folder, tmp_path_factory):
    """A warehouse over copied raw tables, with Spark's own automatic broadcasts switched off."""
    sources = DerivedBronze(spark, folder)
    raw = copy_bronze(spark, sources, str(tmp_path_factory.mktemp("raw")), tuple(sources))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Warehouse(raw, as_of=dt.date(2002, 1, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mart", MART_NAMES)
def test_no_nested_loops_and_no_python(house, mart):
    plan = plan_of(house.mart(mart))
    assert not re.search(r"NestedLoop|CartesianProduct|Python|SinglePartition", plan)


@pytest.mark.parametrize("mart, scans", [("mart_promotion_effectiveness", 2), ("mart_customer_ltv", 2), ("mart_daily_revenue", 2)])
def test_each_sales_table_is_read_for_the_lines_and_their_totals_only(house, mart, scans):
    assert len(re.findall(r"FileScan parquet \[ss_", plan_of(house.mart(mart)))) == scans


def test_scans_read_few_columns_and_push_the_staging_filter(house):
    plan = plan_of(house.mart_daily_revenue)
    scan = next(line for line in plan.splitlines() if "FileScan parquet [ss_" in line)
    assert "ss_list_price" not in scan and "ss_net_profit" not in scan
    assert "IsNotNull(ss_item_sk)" in scan and "IsNotNull(ss_ticket_number)" in scan
    assert "md5" not in plan


@pytest.mark.parametrize("model, join", [
    ("net_sales", "SortMergeJoin [ticket_number"), ("sales_lines", "SortMergeJoin [ticket_number"), ("inventory_daily", "Window "),
])
def test_hashed_keys_and_descriptions_come_after_the_wide_shuffle(house, model, join):
    above, below = plan_of(getattr(house, model)).split(join, 1)
    assert "md5(" in above and "item_description" in above
    assert "md5(" not in below


def test_names_of_stores_come_after_the_shuffle_for_customers(house, monkeypatch):
    monkeypatch.setitem(lookup.lookup.__kwdefaults__, "limit", 0)
    shuffled = Warehouse(house.bronze, as_of=house.as_of)
    before, _ = plan_of(shuffled.mart_customer_ltv).split("Exchange hashpartitioning(known_customer_id", 1)
    above, facts = before.rsplit("SortMergeJoin [customer_id", 1)
    assert "store_state" in above and "store_state" not in facts and "store_id" in facts


def test_marts_need_no_more_of_the_lines_than_is_stored_for_them(house):
    stored = house.mart_lines
    assert "sale_sk" not in stored.columns and "item_description" not in stored.columns
    shared = Warehouse(house.bronze, as_of=house.as_of, lines=stored)
    for mart in MART_NAMES:
        assert shared.mart(mart).schema == house.mart(mart).schema


def test_latest_snapshots_are_pruned_before_the_shuffle(house):
    assert re.search(r"WindowGroupLimit.*Partial", plan_of(house.mart_inventory_health))


def test_shuffles_start_with_partitions_for_the_size_of_the_files(spark, folder, monkeypatch):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for size, want in ((1 << 40, least), (1000, least + 1)):
        monkeypatch.setattr(derived, "PART_BYTES", size)
        derived.DerivedBronze(spark, folder)
        found = int(spark.conf.get(derived.PARTITIONS))
        assert found == least if want == least else found >= want
    monkeypatch.undo()
    derived.DerivedBronze(spark, folder)


FACTS = ("store_sales", "web_sales", "catalog_sales", "store_returns", "web_returns", "inventory")


def test_settled_tables_hold_the_same_rows_and_are_only_scanned(spark, folder):
    plain = DerivedBronze(spark, folder)
    settled = plain.settled()
    for table in FACTS:
        assert settled[table].columns == plain[table].columns
        assert compare_contents(plain[table], settled[table]).where("not same").isEmpty()
        assert not re.search("Join|Exchange", plan_of(settled[table])), table


def test_captured_tables_are_scanned_for_each_half(spark, folder):
    captured = catalog._Captured(spark, folder).append(0).append(1)
    for table in FACTS:
        path, schema = captured.streams[table]
        assert not re.search("Join|Exchange", plan_of(captured.raw[table]))
        appended = spark.read.schema(schema).parquet(path)
        assert compare_contents(DerivedBronze(spark, folder)[table], appended).where("not same").isEmpty()
