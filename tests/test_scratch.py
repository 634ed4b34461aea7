"""Shuffle files and scratch tables that nothing reads any more are deleted."""

import os
from datetime import datetime

import pytest
from conftest import rows
from test_pipeline import feed, trade

from tradeloom.functions.staging import settle, shared_folder, shuffles_dropped
from tradeloom.operators import deadletter
from tradeloom.plans import catalog, pipeline

DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark):
    """Names of the scratch tables that exist now."""
    folder = shared_folder(spark)
    return {name: name.split("-")[0] for name in os.listdir(folder)} if os.path.exists(folder) else {}


@pytest.fixture()
def source(spark, tmp_path):
    """Trades of 1997 and 1998, those of each order on one day."""
    lines = [
        (o, o + n, 7 * o + 1, n, 5.0, 100.0 * o, "R", datetime(1997 + o % 2, 3, 1 + o)) for o in range(1, 9) for n in (1, 2)
    ]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(o, o, "F") for o in range(1, 9)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_dropping_ends_with_its_last_user(spark):
    before = spark.conf.get(DROPPED)
    one, two = shuffles_dropped(spark), shuffles_dropped(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(DROPPED) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(DROPPED) == before


def test_upsert_keeps_no_more_than_it_reads(spark, source, monkeypatch):
    seen, old = {}, scratch(spark)

    def watched(df, name="settled"):
        seen[name] = spark.conf.get(DROPPED)
        return settle(df, name)

    monkeypatch.setattr(catalog, "settle", watched)
    found = catalog.fact_upsert(spark, source)
    left = [kind for name, kind in scratch(spark).items() if name not in old]
    assert {"enriched", "facts"} <= set(left) and not {"cleaned", "groups", "before", "net"} & set(left)
    assert {seen[name] for name in ("cleaned", "enriched", "facts", "dim_date")} == {"true"}
    wanted = [(f"T_{o}_{n}", "b_2" if o % 2 else "b_1", 100.0 * o) for o in range(1, 9) for n in (1, 2)]
    assert rows(found, "trade_id", "batch_id", "notional") == sorted(wanted, key=repr)


@pytest.mark.parametrize("fails", [False, True])
def test_run_keeps_what_its_next_stage_reads(spark, tmp_path, monkeypatch, fails):
    tables, old, seen, load = pipeline.Tables(str(tmp_path)), scratch(spark), {}, pipeline.load_star
    before = spark.conf.get(DROPPED)

    def watched(enriched, *args):
        seen[spark.conf.get(DROPPED)] = {kind for name, kind in scratch(spark).items() if name not in old}
        if fails:
            raise ValueError("no space")
        return load(enriched, *args)

    monkeypatch.setattr(pipeline, "load_star", watched)
    raw = feed(spark, trade("T1"), trade("T1", date="2026-05-19"), trade("T2", "abc"), trade("T3", direction="SELL"))
    if fails:
        with pytest.raises(RuntimeError):
            pipeline.run_pipeline(raw, tables.root, "b_1", "p")
        assert deadletter.read(spark, tables.path("dead_letters")).where("_dlq_stage = 'load'").count() == 2
    else:
        pipeline.run_pipeline(raw, tables.root, "b_1", "p")
        assert rows(pipeline.current_facts(spark, tables), "trade_id") == [("T1",), ("T3",)]
    assert "enriched" in seen["true"] and not {"ingested", "deduplicated"} & seen["true"]
    assert scratch(spark).keys() <= old.keys() and spark.conf.get(DROPPED) == before
    assert tables.read(spark, "pipeline_runs").count() == 4
