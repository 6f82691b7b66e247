"""Rules that are easy to get wrong, on small hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwork import functions as fn
from tillwork.fixed_values import CUSTOMER_REGIONS, STORE_REGIONS, Thresholds
from tillwork.operators import history, inventory, quality, sales
from tillwork.operators.stored_history import LateLoad, StoredHistory
from tillwork.plans import marts

D = dt.date


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "price, tier", [("24.99", "budget"), ("25", "mid"), ("74.99", "mid"), ("75", "premium"), ("200", "luxury"), (None, "luxury")]
)
def test_price_tier(spark, price, tier):
    assert one(spark, fn.price_tier(F.lit(price).cast("decimal(7,2)"))) == tier


def test_regions_differ_between_customers_and_stores(spark):
    nc = fn.state_code(F.lit(" nc "))
    assert one(spark, fn.region_of(nc, CUSTOMER_REGIONS)) == "South"
    assert one(spark, fn.region_of(nc, STORE_REGIONS)) == "Other"
    assert one(spark, fn.region_of(F.lit(None).cast("string"), CUSTOMER_REGIONS)) == "Other"


def test_first_promotion_medium_wins(spark):
    flags = {m: F.lit("N") for m in ("email", "direct_mail", "event", "demo")}
    assert one(spark, fn.channel_type({**flags, "tv": F.lit("Y"), "radio": F.lit("Y")})) == "tv"
    assert one(spark, fn.channel_type({**flags, "tv": F.lit(None), "radio": F.lit("N")})) == "other"


def test_keys_tell_null_from_empty(spark):
    a = one(spark, fn.surrogate_key(F.lit("a"), F.lit(None).cast("string")))
    assert a != one(spark, fn.surrogate_key(F.lit("a"), F.lit("")))
    assert a != one(spark, fn.surrogate_key(F.lit(None).cast("string"), F.lit("a")))


def test_ratios_caps_and_flags_with_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.capped(null, 999)) is None
    assert one(spark, fn.capped(F.lit(5000.0), 999)) == 999.0
    limits = Thresholds()
    flags = [one(spark, fn.stockout_flag(F.lit(v).cast("double"), limits)) for v in (None, 6.9, 7.0, 14.0)]
    assert flags == ["HIGH", "HIGH", "MEDIUM", "LOW"]
    assert one(spark, fn.exact_round(F.lit(1.005), 2)) == 1.01


def test_unknown_channel_fails_while_planning(spark):
    with pytest.raises(ValueError, match="Unknown channel"):
        fn.channel_label("phone")


def test_money_survives_cents(spark):
    assert one(spark, fn.to_money(fn.to_cents(F.lit(Decimal("-12.34"))))) == Decimal("-12.34")


# --- net sales -----------------------------------------------------------------------------------------------------


def sale(spark, rows):
    frame = spark.createDataFrame(
        rows, "channel string, ticket_number bigint, item_id bigint, customer_id bigint, promotion_id bigint, "
        "quantity_sold bigint, gross_amount decimal(12,2), sale_date date",
    )
    for name in sales.UNIFIED_COLUMNS:
        if name not in frame.columns:
            kind = "decimal(12,2)" if name in ("gross_amount_inc_tax", "net_profit", "current_price") else "string"
            frame = frame.withColumn(name, F.lit(None).cast(kind))
    return frame.select(*sales.UNIFIED_COLUMNS)


def returned(spark, rows):
    return spark.createDataFrame(
        rows, "return_channel string, ticket_number bigint, item_id bigint, return_amount decimal(12,2), "
        "quantity_returned bigint",
    )


@pytest.fixture(scope="module")
def retail(spark):
    day = D(2000, 1, 5)
    sold = sale(
        spark,
        [
            ("store", 1, 10, 1, None, 2, Decimal("100.00"), day),  # two returns
            ("web", 2, 10, 1, 3, 1, Decimal("50.00"), day),  # same ticket as the next one, other channel
            ("store", 2, 10, 2, None, 1, Decimal("70.00"), day),
            ("catalog", 4, 10, 2, None, 1, Decimal("30.00"), day),  # return with unknown amount
            ("store", 5, 10, 3, None, 1, None, day),  # unknown amount, never returned
        ],
    )
    back = returned(
        spark,
        [
            ("store", 1, 10, Decimal("20.00"), 1),
            ("store", 1, 10, Decimal("30.00"), 1),
            ("web", 2, 10, Decimal("5.00"), 1),
            ("web", 4, 10, None, 1),
            ("web", 99, 10, Decimal("9.00"), 1),  # no sale
        ],
    )
    return sold, back


def copies_of_returns(sold, back):
    """Returns once per sale of their key, as unified returns have them."""
    keys = sold.select(F.col("ticket_number").alias("t"), F.col("item_id").alias("i"))
    return back.join(keys, (F.col("ticket_number") == F.col("t")) & (F.col("item_id") == F.col("i")), "left").drop("t", "i")


@pytest.mark.parametrize("match_channel", [False, True])
def test_lines_sum_up_to_net_sales(retail, match_channel):
    sold, back = retail
    net = sales.net_sales(sold, copies_of_returns(sold, back), match_channel)
    lines = sales.sales_lines(sold, sales.return_totals(sold, back, match_channel), match_channel)
    keys = ("channel", "ticket_number")
    want = net.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if("was_returned").alias("r"), F.sum("gross_amount").alias("gross"),
        F.sum("net_amount").alias("net"), F.sum("quantity_sold").alias("units"),
        F.sum(F.coalesce("return_amount", F.lit(0))).alias("refund"),
    )
    got = lines.groupBy(*keys).agg(
        F.sum("copies").alias("n"), F.sum("returned_copies").alias("r"), fn.to_money(F.sum("gross_cents")).alias("gross"),
        fn.to_money(F.sum("net_cents")).alias("net"), F.sum("line_units").alias("units"),
        fn.to_money(F.sum("refund_cents")).alias("refund"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_returns_cross_channels_unless_told_otherwise(retail):
    sold, back = retail
    crossed = sales.net_sales(sold, copies_of_returns(sold, back))
    # Two sales and one return of ticket 2: the return has two copies, and each sale meets both.
    assert crossed.where("ticket_number = 2").count() == 4
    matched = sales.net_sales(sold, copies_of_returns(sold, back), match_channel=True)
    assert matched.where("ticket_number = 2 and channel = 'store' and was_returned").isEmpty()
    assert matched.where("ticket_number = 4 and was_returned").isEmpty()


# --- inventory ------------------------------------------------------------------------------------------------------


def test_rolling_average_counts_rows_not_days(spark):
    first = D(2000, 1, 1)
    days = [first + dt.timedelta(days=i if i < 20 else i + 100) for i in range(35)]
    rows = [(i, 1, 1, 10, day, i) for i, day in enumerate(days)] + [(0, 2, 1, 10, first, 0)]
    snapshots = spark.createDataFrame(
        rows, "date_sk bigint, item_id bigint, warehouse_id bigint, quantity_on_hand bigint, inv_date date, "
        "units_sold_that_day bigint",
    )
    averaged = {(r.item_id, r.inv_date): r for r in inventory.rolling_average(snapshots).collect()}
    assert averaged[1, days[34]].avg_daily_sales_30d == sum(range(5, 35)) / 30
    assert averaged[1, days[3]].avg_daily_sales_30d == 1.5
    assert averaged[2, first].days_of_supply is None


# --- customers ------------------------------------------------------------------------------------------------------


def test_preferred_channel_ties_and_unknown_spend(spark):
    lines = spark.createDataFrame(
        [(1, "web", 500), (1, "store", 500), (2, "web", 900), (2, "catalog", None), (3, "store", -5), (None, "web", 1)],
        "customer_id bigint, channel string, net_cents bigint",
    )
    best = {r.customer_id: r.preferred_channel for r in marts.preferred_channel(lines).collect()}
    assert best == {1: "store", 2: "catalog", 3: "store"}


# --- promotions -----------------------------------------------------------------------------------------------------


def test_baseline_is_the_thirty_days_before(spark):
    start = D(2000, 3, 1)
    dates = spark.createDataFrame([(i, start + dt.timedelta(days=i)) for i in range(10)], "date_sk bigint, calendar_date date")
    promotions = spark.createDataFrame(
        [(1, "c", "n", 0, 5, "Y", "tv"), (2, "c", "n", None, 5, "Y", "tv")],
        "promotion_id bigint, promotion_code string, promotion_name string, start_date_sk bigint, end_date_sk bigint, "
        "is_discount_active string, channel_type string",
    )
    windows = marts.promo_windows(promotions, dates)
    assert [r.promotion_id for r in windows.collect()] == [1]
    lines = spark.createDataFrame(
        [(None, start + dt.timedelta(days=d), 1, 100, 100, 0, 0, 1) for d in (-31, -30, -1, 0)],
        "promotion_id bigint, sale_date date, copies bigint, gross_cents bigint, net_cents bigint, refund_cents bigint, "
        "returned_copies bigint, customer_id bigint",
    )
    assert marts.baseline_sales(lines, windows).first()["baseline_transaction_count"] == 2
    quiet = marts.promotion_effectiveness(lines.where("false"), promotions, dates).first()
    assert quiet["revenue_lift_pct"] is None and quiet["promo_net_revenue"] == 0


# --- history --------------------------------------------------------------------------------------------------------


def test_history_versions(spark):
    schema = "customer_id bigint, first_name string, state_code string, zip_code string, city string"
    t1, t2, t3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
    first = spark.createDataFrame([(1, "a", None, "1", "x"), (2, "b", None, "1", "x"), (3, "c", "CA", "1", "x")], schema)
    second = spark.createDataFrame([(1, "a2", None, "1", "x"), (2, "b", "TX", "1", "x"), (4, "d", "CA", "1", "x")], schema)
    versions = history.scd2_merge(history.first_history(first, t1), second, t2)
    versions = history.scd2_merge(versions, first, t3)
    spans = sorted((r.customer_id, r.dbt_valid_from.month, r.dbt_valid_to and r.dbt_valid_to.month) for r in versions.collect())
    # 1 keeps its version (NULL equals NULL, names are not tracked); 2 moves twice; 3 leaves and returns; 4 comes and goes.
    assert spans == [(1, 1, None), (2, 1, 2), (2, 2, 3), (2, 3, None), (3, 1, 2), (3, 3, None), (4, 2, 3)]
    assert versions.where("customer_id = 1").first()["first_name"] == "a"
    at_t2 = history.scd2_as_of(versions, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    assert sorted(r.customer_id for r in at_t2.collect()) == [1, 2, 4]


def test_stored_history_moves_only_what_comes_in(spark, tmp_path):
    """Loads into buckets equal merges of the whole history; closed files stay as they are, lost and repeated loads don't
    show, older loads are refused, and a new session goes on where the last one ended."""
    schema = "customer_id bigint, first_name string, state_code string, zip_code string, city string"

    def people(keep, city):
        return spark.range(300).where(keep).select(
            F.col("id").alias("customer_id"), F.lit("n").alias("first_name"), F.lit(None).cast("string").alias("state_code"),
            F.lit("1").alias("zip_code"), F.expr(city).alias("city"),
        )

    times = [dt.datetime(2024, m, 1) for m in (1, 2, 3, 4)]
    loads = [people("id % 5 <> 1", "'x'"), people("id % 7 <> 2", "if(id % 3 = 0, 'y', 'x')"), people("true", "if(id % 4 = 0, 'z', 'x')")]
    plain = history.first_history(loads[0], times[0])
    store = StoredHistory(spark, str(tmp_path / "people"), buckets=5)
    assert store.newest() is None
    assert store.load(loads[0], times[0]) == 1
    for n, (rows, at) in enumerate(zip(loads[1:], times[1:]), start=2):
        plan = store.merged(rows, at)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        files = {f: f.stat().st_mtime_ns for f in (tmp_path / "people/data").rglob("*.parquet")}
        assert store.load(rows, at) == n and store.load(loads[0], at) == n
        assert all(f.stat().st_mtime_ns == t for f, t in files.items())
        plain = history.scd2_merge(plain, rows, at)
        assert sorted(map(str, store.read().select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(LateLoad):
        store.load(loads[0], times[0])
    second = store.read(2).count()
    # A run that is lost behind its data and before its entry in the log: nothing of it shows.
    store._write(store.merged(loads[0].limit(0), times[3]).withColumn("state", F.lit("closed")), 4, 5)
    assert sorted(map(str, store.read().select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    later = StoredHistory(spark.newSession(), str(tmp_path / "people"))
    again = later.spark.createDataFrame([(1, "n", None, "1", "x")], schema)
    plan = later.merged(again, times[3])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert later.load(again, times[3]) == 4 and later.read(2).count() == second
    later.publish("people_history")
    assert spark.table("people_history").where("dbt_valid_to is null").select("customer_id").collect() == [(1,)]
    spark.sql("drop view people_history")


@pytest.mark.parametrize("spread", [False, True])
def test_facts_meet_the_version_of_their_time(spark, spread):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    schema = "customer_id bigint, state_code string, zip_code string, city string"
    versions = history.first_history(spark.createDataFrame([(1, "CA", "1", "old")], schema), t1)
    versions = history.scd2_merge(versions, spark.createDataFrame([(1, "CA", "1", "new")], schema), t2)
    times = [dt.datetime(2023, 12, 31), t1, dt.datetime(2024, 1, 31, 23, 59, 59), t2]
    facts = spark.createDataFrame([(1, t) for t in times] + [(2, t1), (None, t1)], "buyer bigint, at timestamp_ntz")
    hot = [r[0] for r in spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).collect()] if spread else []
    joined = history.join_as_of(facts, versions, "buyer", "at", hot=hot)
    cities = {(r.buyer, r["at"]): r.as_of_city for r in joined.collect()}
    assert [cities[1, t] for t in times] == [None, "old", "old", "new"]
    assert cities[2, t1] is None and cities[None, t1] is None and len(cities) == 6


def test_facts_of_a_key_with_many_versions(spark):
    """Equal to the range join; gaps between versions and facts without time or key have no version. Nothing is joined,
    so work grows with facts and versions and not with their pairs."""
    day = lambda column: F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval({column})")
    versions = spark.range(400).select(
        (F.col("id") % 2).alias("customer_id"), F.col("id").alias("version"), day("int(id * 3)").alias("dbt_valid_from"),
        F.when(F.col("id") < 390, day("int(id * 3 + if(id % 5 = 0, 2, 6))")).alias("dbt_valid_to"),
    )
    facts = spark.range(3000).select(
        F.col("id").alias("fact"),
        F.when(F.col("id") % 17 != 0, F.expr("if(id % 3 = 0, id % 4, 1)")).alias("buyer"),
        F.when(F.col("id") % 19 != 0, day("int(id % 1300 - 20)")).alias("at"),
    )
    known = (F.col("buyer") == F.col("customer_id")) & (F.col("dbt_valid_from") <= F.col("at"))
    known &= F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") > F.col("at"))
    last = versions.groupBy("customer_id").agg(F.max("version").alias("version"))
    versions = versions.where("dbt_valid_to is not null").unionByName(versions.where("dbt_valid_to is null").join(last, ["customer_id", "version"]))
    want = sorted((r.fact, r.version) for r in facts.join(versions, known, "left").collect())
    assert len(want) == 3000
    busy = [r[0] for r in spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).collect()]
    for hot in ([], busy, spark.createDataFrame([(busy[0],)], "key long")):
        joined = history.join_as_of(facts, versions, "buyer", "at", hot=hot, ways=5)
        assert sorted((r.fact, r.as_of_version) for r in joined.collect()) == want
    assert "SortMergeJoin" not in joined._jdf.queryExecution().executedPlan().toString()


# --- quality --------------------------------------------------------------------------------------------------------


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (5,), (9,)], "v bigint")
    assert quality.dq_not_null(df, "v").count() == 1
    assert [tuple(r) for r in quality.dq_unique(df, "v").collect()] == [(1, 2)]
    assert [r.value_field for r in quality.dq_accepted_values(df, "v", (1, 5)).collect()] == [9]
    assert sorted(r.v for r in quality.dq_between(df, "v", low=2, high=8).collect()) == [1, 1, 9]
    assert quality.dq_between(df, "v", low=1).isEmpty()


@pytest.mark.parametrize("hours, status", [(24, "pass"), (26, "warn"), (50, "error"), (None, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 1, 10)
    rows = [] if hours is None else [(now - dt.timedelta(hours=hours),)]
    loaded = spark.createDataFrame(rows, "_ingested_at timestamp_ntz")
    assert quality.dq_freshness(loaded, "_ingested_at", now).first()["status"] == status


def test_gate_raises_and_names_the_check(spark):
    df = spark.createDataFrame([(1,), (1,)], "k bigint")
    checks = [quality.Check("m", "k", "not_null"), quality.Check("m", "k", "unique")]
    with pytest.raises(quality.CheckFailed, match=r"unique\.m\.k \(1\)"):
        quality.dq_checkpoint({"m": df}, checks, "gold")
    assert quality.dq_checkpoint({"m": df.limit(1)}, checks, "gold").count() == 2


def test_number_of_declared_checks():
    declared = [*quality.STAGING_CHECKS, *quality.MART_CHECKS]
    kinds = {kind: sum(c.kind == kind for c in declared) for kind in ("not_null", "unique", "accepted_values", "between")}
    assert kinds == {"not_null": 31, "unique": 15, "accepted_values": 12, "between": 8}
