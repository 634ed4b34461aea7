import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from conftest import rows

from tradeloom.functions.staging import settle, tracked
from tradeloom.operators import clean


def test_null_fill_keeps_types(spark):
    df = spark.createDataFrame(
        [(None, None, None, "x"), ("5.0", 3, "EUR", None)],
        "notional string, quantity int, currency string, note string",
    )
    out = clean.null_fill(df, {"note": "none"})
    assert out.dtypes == df.dtypes
    assert rows(out) == [("0.0", 0, "USD", "x"), ("5.0", 3, "EUR", "none")]


def test_null_fill_counts(spark):
    df = spark.createDataFrame([(None,), (None,), ("USD",)], "currency string")
    assert rows(clean.null_fill_counts(df)) == [("currency", 2, "USD")]


def test_type_cast_keeps_raw_values_of_rejects(spark):
    df = spark.createDataFrame(
        [("T1", "1.5", "2026-05-20 00:00:00"), ("T2", "abc", "2026-05-20"),
         ("T3", None, None), ("T4", "x", "y")],
        "trade_id string, notional string, trade_date string",
    )
    good, bad = clean.type_cast(df)
    assert dict(good.dtypes) == {"trade_id": "string", "notional": "double", "trade_date": "timestamp_ntz"}
    assert [r[0] for r in rows(good, "trade_id")] == ["T1", "T3"]
    assert rows(bad, "trade_id", "notional", "_failed_columns") == [
        ("T2", "abc", "notional"), ("T4", "x", "notional,trade_date"),
    ]
    assert clean.cast_columns(df).count() == 4


def test_row_hash_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert len({r.row_hash for r in clean.row_hash(df).collect()}) == 2


def test_dedup_keeps_latest_and_one_null_key(spark):
    df = spark.createDataFrame(
        [("A", 1, "x"), ("A", 3, "b"), ("A", 3, "a"), (None, 1, "n"), (None, 2, "m"), ("B", None, "z")],
        "trade_id string, trade_date int, note string",
    )
    assert rows(clean.dedup(df)) == [("A", 3, "a"), ("B", None, "z"), (None, 2, "m")]
    assert rows(clean.dedup(df, ascending=True), "note") == [("n",), ("x",), ("z",)]
    assert clean.dedup(df.drop("trade_date")).count() == 6


def test_dedup_split_is_whole_with_hot_keys_and_copies(spark):
    pick = random.Random(1)
    data = [(pick.choice(["A", "B", "C", None]), pick.randint(1, 3), pick.choice("xy")) for _ in range(60)]
    data += [("HOT", 1, "same")] * 50 + [("D", 1, "x")]
    df = spark.createDataFrame(data, "trade_id string, trade_date int, note string")
    kept, rest = clean.dedup_split(df)
    kept, rest = [tuple(r) for r in kept.collect()], [tuple(r) for r in rest.collect()]
    assert Counter(kept) + Counter(rest) == Counter(data)
    best = {}
    for key, date, note in data:
        best[key] = min(best.get(key, (0, "~")), (-date, note))
    assert {(k, -d, n) for k, (d, n) in best.items()} == set(kept) and len(kept) == len(best)


def test_missing_columns(spark):
    assert clean.missing_columns(spark.range(1), ["id", "x"]) == ["x"]


def test_dedup_split_changes_no_value(spark):
    df = spark.sql(
        "SELECT id % 2 AS trade_id, id AS trade_date, -0.0D AS v, parse_json('{\"a\":1}') AS j, map('k', id) AS m FROM range(20)"
    )
    kept, rest = clean.dedup_split(df)
    assert (kept.count(), rest.count()) == (2, 18)
    assert {str(r.v) for r in rest.select("v").collect()} == {"-0.0"}
    assert rest.select(F.map_values("m").alias("m"), F.to_json("j").alias("j")).distinct().count() == 18


@pytest.mark.parametrize("hot_rows", [0, 100_000])
def test_dedup_settled_moves_rows_once_but_for_hot_keys(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(clean, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(clean, "KEY_BUCKETS", 64)
    data = [("HOT", i % 7, "x") for i in range(900)] + [(None, 1, "n"), (None, 2, "m")] + [(f"T{i % 90}", i, "y") for i in range(100)]
    df = settle(spark.createDataFrame(data, "trade_id string, trade_date int, note string").repartition(6))
    with tracked() as made:
        kept, rest, left, repeats = clean.dedup_settled(df)
    assert rows(kept) == rows(clean.dedup(df)) and (left, repeats) == (92, 1002 - 92)
    assert Counter(rows(kept)) + Counter(rows(rest)) == Counter(rows(df))
    written = sorted(path.rsplit("/", 1)[1].split("-")[0] for path in made)
    assert written == (["deduplicated"] if hot_rows else ["deduplicated", "hot", "won"])
