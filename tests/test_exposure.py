import hashlib
import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.functions.money import exact_sum
from tradeloom.functions.ordering import number_rows, slice_of
from tradeloom.functions.staging import tracked
from tradeloom.operators import exposure, star

SCHEMA = (
    "trade_id string, counterparty_id string, product_id string, asset_class string, "
    "direction string, trade_date timestamp_ntz, notional_usd double"
)


def _trades(n=300, seed=3):
    pick = random.Random(seed)
    start = datetime(2026, 1, 1)
    moments = [start + timedelta(days=d, seconds=s, microseconds=m) for d in (0, 1) for s in (0, 5) for m in (0, 9)]
    return [
        (f"T{i}", pick.choice(["A", "A", "A", "B", None]), pick.choice(["P", "Q", None]),
         pick.choice(["FX", "Rates"]), pick.choice(["BUY", "buy", "SELL", None]), pick.choice([*moments, None]),
         pick.choice([None, round(pick.uniform(-9e4, 9e4), 2), 10.0]))
        for i in range(n)
    ]


def _order(row):
    spread = hashlib.md5((row[0] or "").encode()).hexdigest()
    return (row[5] is not None, row[5] or datetime.min, spread, row[0])


def _sliced(spark, df, slices):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return exposure.running_exposure(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("slices", ["1", "5", "40"])
def test_running_exposure_matches_a_plain_loop(spark, slices):
    data = _trades()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    found = {r.trade_id: r.running_notional_usd for r in _sliced(spark, df, slices)}
    expected = {}
    for party in {r[1] for r in data}:
        total, seen = 0, False
        for row in sorted((r for r in data if r[1] == party), key=_order):
            if row[6] is not None:
                total, seen = total + round(row[6] * 100), True
            expected[row[0]] = total / 100 if seen else None
    assert found == expected


def test_totals_and_net_positions(spark):
    data = _trades()
    df = spark.createDataFrame(data, SCHEMA)
    out = exposure.position_net_rows(exposure.exposure_rollup(df)).collect()
    assert len(out) == len(data)

    def total(rows):
        amounts = [round(r[6] * 100) for r in rows if r[6] is not None]
        return sum(amounts) / 100 if amounts else None

    for r in out:
        mine = [d for d in data if d[1] == r.counterparty_id]
        assert r.cpty_total_notional_usd == total(mine) and r.cpty_trade_count == len(mine)
        assert r.asset_class_exposure_usd == total([d for d in data if d[3] == r.asset_class])
        pair = [d for d in mine if d[2] == r.product_id]
        bought = total([d for d in pair if (d[4] or "").upper() == "BUY"]) or 0.0
        sold = total([d for d in pair if d[4] == "SELL"]) or 0.0
        assert (r.buy_notional_usd, r.sell_notional_usd) == (bought, sold)
        assert r.net_notional_usd == bought - sold
    net = exposure.position_net(df).agg(F.sum("net_notional_usd"), F.sum("buy_notional_usd"), F.sum("sell_notional_usd")).first()
    assert net[0] == pytest.approx(net[1] - net[2])


def test_skips_without_needed_columns(spark):
    df = spark.range(1)
    assert exposure.exposure_rollup(df).columns == ["id"]
    assert exposure.position_net_rows(df).columns == ["id"]


def test_exact_sum_keeps_amounts_that_do_not_fit(spark):
    df = spark.createDataFrame(
        [("a", 1e300), ("a", 1.5), ("b", float("nan")), ("b", 2.0), ("c", None), ("d", 0.1), ("d", 0.2)],
        "k string, v double",
    )
    out = {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert out["a"] == 1e300 and math.isnan(out["b"]) and out["c"] is None and out["d"] == 0.3


def test_number_rows_is_global_and_dense(spark):
    names = [f"k{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    out = number_rows(df, ["name"], "key", start=10).collect()
    assert {r.name: r.key for r in out} == {n: 11 + i for i, n in enumerate(sorted(names))}


def test_sketches_count_distinct_values(spark):
    products = spark.createDataFrame([(1, "FX"), (2, "Equity")], "product_key int, asset_class string")
    facts = spark.range(60_000).select(
        (F.col("id") % 2 + 1).cast("int").alias("product_key"), (F.lit(20260101) + F.col("id") % 20).cast("int").alias("trade_date_key"),
        (F.col("id") % 7).cast("int").alias("counterparty_key"), F.concat(F.lit("T"), F.col("id") % 40_000).alias("trade_id"),
    )
    few = star.distinct_sketches(facts, products)
    assert few.count() == 20
    assert rows(star.distinct_of_period(few, 20260101, 20260103)) == [("Equity", 7), ("FX", 7)]
    exact = dict(facts.where("trade_date_key <= 20260115").join(products, "product_key").groupBy("asset_class").agg(F.countDistinct("trade_id")).collect())
    many = star.distinct_sketches(facts, products, "trade_id")
    for row in star.distinct_of_period(many, 20260101, 20260115).collect():
        assert abs(row.distinct_values - exact[row.asset_class]) < 0.05 * exact[row.asset_class]


def test_running_exposure_moves_whole_rows_once(spark):
    df = spark.createDataFrame(_trades(), SCHEMA)
    with tracked() as made:
        out = exposure.running_exposure(df)
    assert not [path for path in made if "slices" in path]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in plan


def test_slices_follow_the_order_and_are_even(spark):
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("n"), F.timestamp_seconds(F.col("id") * 7919 % 4000).alias("t"))
    placed = df.select("n", slice_of(df, [F.col("t"), F.col("n")], 4000).alias("s")).orderBy("n").collect()
    assert [r.s for r in placed] == sorted(r.s for r in placed)
    sizes = [sum(r.s == s for r in placed) for s in {r.s for r in placed}]
    assert len(sizes) == 32 and max(sizes) < 400
