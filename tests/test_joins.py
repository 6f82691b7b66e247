"""Joins with hot and missing keys give the rows of the plain join, however the work is spread."""

import pytest
from pyspark.sql import functions as F

from tillwork.operators import keys, lookup
from tillwork.plans import marts


@pytest.fixture(autouse=True)
def spread_small_facts_too(monkeypatch):
    monkeypatch.setattr(lookup, "SPREAD_BYTES", 0)


def hashes(df, column, parts=10):
    return [r.key for r in keys.hot_keys(keys.summarize(df, [column]), parts).collect()]


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has key 7, another third has no key."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).cast("bigint").alias("k"),
        F.col("id").alias("fact"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(40).select(F.col("id").alias("dim_k"), (F.col("id") * 10).alias("label"))


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(facts, dim, how):
    hot = hashes(facts, "k")
    salted = lookup.spread_join(facts, dim, {"k": "dim_k"}, how, spread_by=("fact",), hot=hot, ways=5)
    same(salted, facts.join(dim, F.col("k") == F.col("dim_k"), how))


def test_hot_keys_are_found_and_few(facts, spark):
    hot = hashes(facts, "k")
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert seven in hot and len(hot) <= 10


def test_missing_keys_are_spread_over_tasks(facts, dim):
    joined = lookup.spread_join(facts, dim, {"k": "dim_k"}, spread_by=("fact",), hot=[], ways=8)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    same(joined, facts.join(dim, F.col("k") == F.col("dim_k"), "left"))


@pytest.mark.parametrize("as_frame", [True, False])
@pytest.mark.parametrize("side", ["left", "right", "both", "none"])
def test_many_to_many_left_join(spark, side, as_frame):
    left = spark.range(300).select(
        F.when(F.lit(side in ("left", "both")) & (F.col("id") % 3 == 0), 5).otherwise(F.col("id") % 60).alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(240).select(
        F.when(F.lit(side in ("right", "both")) & (F.col("id") % 3 == 0), 5).otherwise(F.col("id") % 45).alias("rk"),
        F.col("id").alias("r"),
    )
    left = left.withColumn("k", F.expr("if(l % 11 = 1, null, k)"))
    right = right.withColumn("rk", F.expr("if(r % 13 = 1, null, rk)"))
    hot = sorted({*hashes(left, "k"), *hashes(right, "rk")})
    # A hot key without any partner must keep its rows too.
    lonely = spark.range(1).select(F.xxhash64(F.lit(50).cast("bigint"))).first()[0]
    hints = [*hot, lonely]
    if as_frame:
        hints = spark.createDataFrame([(h,) for h in hints], "key long")
    joined = lookup.fanout_left_join(left, right, {"k": "rk"}, spread_left=("l",), spread_right=("r",), hot=hints, ways=9)
    same(joined, left.join(right, F.col("k") == F.col("rk"), "left"))


def test_large_dimension_is_not_broadcast(facts, dim):
    plan = lookup.lookup(facts, dim, {"k": "dim_k"}, limit=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    hinted = lookup.lookup(facts, dim, {"k": "dim_k"})._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in hinted


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    """Items in files of 40 MB as stored, but for a broadcast many times as much: five million of them."""
    path = str(tmp_path_factory.mktemp("packed") / "items")
    listed = spark.range(0, 5_000_000, 1, 4).select("id", F.lit("toys").alias("category"), F.lit("mid").alias("price_tier"))
    listed.write.option("compression", "none").option("parquet.enable.dictionary", "true").parquet(path)
    items = spark.read.parquet(path).withColumnRenamed("id", "item_id")
    assert 16 * 1024**2 < lookup.input_bytes(items) < 64 * 1024**2
    return items


@pytest.fixture
def ready_to_broadcast(spark):
    """Spark itself would broadcast anything."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packed_dimension_beyond_the_limit_is_not_broadcast(facts, packed, ready_to_broadcast):
    """The driver would hold it as a whole. Spark may still choose for frames whose inputs say nothing about them."""
    joined = lookup.lookup(facts, packed, {"k": "item_id"})
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    free = lookup.lookup(facts, packed, {"k": "item_id"}, limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in free
    same(joined, facts.join(packed, F.col("k") == F.col("item_id"), "left"))


def test_returns_by_promo_flag_of_many_items(spark, packed, ready_to_broadcast):
    """Returns of known items and of an unknown one, without a broadcast of all items."""
    returns = spark.createDataFrame(
        [(1, 10, 2, 5.0), (1, 10, 1, 2.5), (2, 11, 4, 1.0), (3, -1, 7, 3.0)],
        "ticket_number long, item_id long, quantity_returned long, return_amount double",
    ).withColumn("return_amount", F.col("return_amount").cast("decimal(12,2)"))
    sold = spark.createDataFrame([(1, 10, 5), (1, 10, None)], "ticket_number long, item_id long, promotion_id long")
    found = marts.returns_by_promo_flag(returns, sold, packed)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    columns = ("item_id", "was_promoted", "units_returned", "gross_return_value", "category")
    rows = {(r[0], r[1]): (r[2], float(r[3]), r[4]) for r in found.select(*columns).collect()}
    assert rows == {
        (10, True): (3, 7.5, "toys"), (10, False): (3, 7.5, "toys"), (11, False): (4, 1.0, "toys"), (-1, False): (7, 3.0, None)
    }


def test_a_hot_key_costs_one_pass_over_each_side(spark, tmp_path):
    """The plan that ran reads each side once: the keys with a partner are counted from the exchange of the join."""
    for name, step in (("left", 60), ("right", 45)):
        key = F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % step).alias(name)
        spark.range(3000).select(key, F.col("id").alias(f"{name}_row"), F.lit(1).alias(f"{name}_more")).write.parquet(
            str(tmp_path / name)
        )
    left, right = (spark.read.parquet(str(tmp_path / name)) for name in ("left", "right"))
    hot = hashes(left, "left")
    assert hot
    joined = lookup.fanout_left_join(
        left, right, {"left": "right"}, spread_left=("left_row",), spread_right=("right_row",), show=("right_more",), hot=hot, ways=9
    ).groupBy("left", "right_more").agg(F.count("*").alias("n"))
    plain = left.join(right, F.col("left") == F.col("right"), "left").groupBy("left", "right_more").agg(F.count("*").alias("n"))
    same(joined, plain)
    ran = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ran.count("FileScan") == 2 and "ReusedExchange" in ran


def test_summaries_merge_and_follow_partitions(spark):
    """Summaries of parts say the same as one of the whole; a key is hot if it exceeds a mean partition."""
    parts = [spark.range(1000 * i, 1000 * i + 1000).select(F.expr("if(id % 4 = 0, 1, id)").cast("bigint").alias("k")) for i in range(3)]
    whole = parts[0].union(parts[1]).union(parts[2])
    both = [keys.summarize(p, ["k"]) for p in parts]
    merged = both[0].unionByName(both[1]).unionByName(both[2])
    top = {r.key: (r.n, r.n_rows) for r in keys.frequent(merged).where("n > 1").collect()}
    assert top == {spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).first()[0]: (751, 3000)}
    assert top == {r.key: (r.n, r.n_rows) for r in keys.frequent(keys.summarize(whole, ["k"])).where("n > 1").collect()}
    assert keys.hot_keys(merged, 3).count() == 0 and keys.hot_keys(merged, 4).count() == 1
    nothing = keys.summarize(whole.where("k is null"), ["k"])
    assert keys.hot_keys(nothing, 100).count() == 0
