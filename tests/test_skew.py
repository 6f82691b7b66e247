"""A third of the store sales share one ticket, item and customer: salted plans give the rows of the plain ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillwork.operators import lookup
from tillwork.plans.warehouse import MART_NAMES, Warehouse
from tillwork.sources import DerivedBronze, copy_bronze


def skewed(spark, folder):
    raw = dict(DerivedBronze(spark, folder).items())
    busy = F.col("ss_item_sk") % 3 == 0
    same = {"ss_ticket_number": 1, "ss_customer_sk": 1, "ss_item_sk": 5}
    raw["store_sales"] = raw["store_sales"].withColumns(
        {c: F.when(busy, F.lit(v).cast("bigint")).otherwise(F.col(c)) for c, v in same.items()}
    )
    back = F.col("sr_item_sk") % 50 == 0
    raw["store_returns"] = raw["store_returns"].withColumns(
        {
            "sr_ticket_number": F.when(back, F.lit(1).cast("bigint")).otherwise(F.col("sr_ticket_number")),
            "sr_item_sk": F.when(back, F.lit(5).cast("bigint")).otherwise(F.col("sr_item_sk")),
        }
    )
    return raw


@pytest.mark.parametrize("mart", ["mart_daily_revenue", "mart_customer_ltv", "mart_inventory_health"])
def test_marts_agree_on_skewed_sales(spark, folder, monkeypatch, mart):
    raw = skewed(spark, folder)
    plain = sorted(map(tuple, Warehouse(raw, as_of=dt.date(2002, 1, 1)).mart(mart).collect()), key=repr)
    monkeypatch.setattr(lookup, "SPREAD_BYTES", 0)
    monkeypatch.setitem(lookup.lookup.__kwdefaults__, "limit", 0)
    house = Warehouse(raw, as_of=dt.date(2002, 1, 1))
    salted = house.mart(mart)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, salted.collect()), key=repr) == plain


def test_lines_of_a_hot_key_equal_its_net_sales(spark, folder):
    """Hundreds of sales and dozens of returns of one key: all pairs when asked row by row, no pairs in the marts."""
    house = Warehouse(skewed(spark, folder), as_of=dt.date(2002, 1, 1))
    hot = "ticket_number = 1 and item_id = 5"
    rows = house.net_sales.where(hot).agg(F.count("*"), F.sum("net_amount"), F.count_if("was_returned")).first()
    lines = house.sales_lines.where(hot)
    sums = lines.agg(F.sum("copies"), F.sum("net_cents"), F.sum("returned_copies")).first()
    assert (rows[0], rows[1] * 100, rows[2]) == tuple(sums)
    assert rows[0] > 100 * lines.count()


def test_plans_with_hot_keys_are_built_without_a_job(spark, folder, monkeypatch, tmp_path):
    """Marts and net sales over copied tables: hints come from the stored summaries while the plan runs, and nothing
    runs while it is built; net sales with them are the plain ones."""
    raw = skewed(spark, folder)
    raw["store_sales"] = raw["store_sales"].where("ss_ticket_number <> 1 or ss_quantity < 12")  # else too many pairs
    plain = Warehouse(raw, as_of=dt.date(2002, 1, 1))
    copied = copy_bronze(spark, raw, str(tmp_path), tuple(raw))
    for table in copied:
        copied[table]  # opening files reads their schema
    monkeypatch.setattr(lookup, "SPREAD_BYTES", 0)
    monkeypatch.setitem(lookup.lookup.__kwdefaults__, "limit", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # so that the key exceeds a mean partition
    spark.sparkContext.setJobGroup("building", "plans")
    try:
        house = Warehouse(copied, as_of=dt.date(2002, 1, 1))
        net, back, marts = house.net_sales, house.unified_returns, [house.mart(name) for name in MART_NAMES]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
        assert house.hot_keys("sale").count() >= 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all("approx_top_k" in f._jdf.queryExecution().optimizedPlan().toString() for f in (net, back, marts[0]))
    for found, want in ((net, plain.net_sales), (back, plain.unified_returns)):
        sums = [F.count("*"), F.sum(F.xxhash64(*want.columns).cast("decimal(38,0)"))]
        assert found.select(*want.columns).agg(*sums).first() == want.agg(*sums).first()
