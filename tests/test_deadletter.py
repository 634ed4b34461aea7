import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.operators import deadletter


def test_stages_with_different_types_share_a_table(spark, tmp_path):
    path = str(tmp_path / "dead")
    text = spark.createDataFrame([("T1", "abc")], "trade_id string, notional string")
    typed = spark.createDataFrame([("T2", 1.5)], "trade_id string, notional double")
    deadletter.write(text, path, "x" * 600, "b1", "TypeCast")
    deadletter.write(typed, path, "duplicate", "b2", "Dedup")
    found = deadletter.read(spark, path, schema=typed.schema)
    assert rows(found, "trade_id", "notional", "_dlq_stage") == [("T1", None, "TypeCast"), ("T2", 1.5, "Dedup")]
    only = deadletter.read(spark, path, "b1")
    assert only.first().notional == "abc" and len(only.first()._dlq_reason) == 600
    assert rows(deadletter.count_by_batch(found)) == [("b1", "TypeCast", 1), ("b2", "Dedup", 1)]
    again = deadletter.reprocess(found, lambda df: df.withColumn("ok", F.lit(True)))
    assert again.columns == ["trade_id", "notional", "ok"]


def test_reading_nothing_gives_no_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "trade_id string, notional double").schema
    found = deadletter.read(spark, str(tmp_path / "none"), schema=schema)
    assert found.count() == 0 and "_dlq_reason" in found.columns


def test_routing_loses_no_row(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    good, bad = deadletter.route(df, F.col("k") == "a")
    assert (good.count(), bad.count()) == (2, 1)
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    kept, dead = deadletter.route_keys(df, keys, "k")
    assert rows(kept, "v") == [(2,), (3,)] and rows(dead, "v") == [(1,)]


def test_failed_step_keeps_its_input_once(spark, tmp_path):
    path = str(tmp_path / "dead")
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    broken = lambda d: d.withColumn("n", F.col("k").cast("int"))
    sink = lambda d: d.write.format("noop").mode("overwrite").save()
    with pytest.raises(Exception):
        deadletter.run_or_bury(df, broken, sink, path, "b1", "Broken")
    assert deadletter.read(spark, path).count() == 2
