from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import TRADES_CSV_SCHEMA
from tradeloom.functions.staging import settle, settle_counted
from tradeloom.operators import clean, deadletter, lineage, star
from tradeloom.plans import observability, pipeline, registry
from tradeloom.plans.facts import FactStore
from tradeloom.sources import files

SCHEMA = (
    "trade_id string, product_id string, counterparty_id string, asset_class string, currency string, "
    "direction string, notional string, quantity double, trade_date string, settlement_date string, "
    "settlement_status string, exchange string"
)


def trade(key, notional="100.00", direction="BUY", date="2026-05-20", status="SETTLED", party="CP001", product="P1"):
    return (key, product, party, "FX", "EUR", direction, notional, 5.0, f"{date} 00:00:00",
            f"{date} 00:00:00", status, "LSE")


def feed(spark, *trades):
    return spark.createDataFrame(list(trades), SCHEMA)


@pytest.fixture()
def tables(tmp_path):
    return pipeline.Tables(str(tmp_path / "warehouse"))


def test_two_runs_of_a_pipeline(spark, tables):
    first = feed(
        spark, trade("T1"), trade("T1", date="2026-05-19"), trade("T2", "abc"), trade("T3", direction="buy"),
        trade("T4", None, status="ODD"), trade(None), trade("T5", party="CP009", product=None),
    )
    run = pipeline.run_pipeline(first, tables.root, "b_1", "p")
    counts = {r[3]: r[4:8] for r in run.results}
    assert counts == {
        "ingest": ("SUCCESS", 7, 7, 0), "clean": ("SUCCESS", 7, 5, 2),
        "enrich": ("SUCCESS", 5, 5, 0), "load": ("SUCCESS", 5, 5, 2),
    }
    facts = pipeline.current_facts(spark, tables)
    assert rows(facts, "trade_id", "trade_key", "notional", "status_key", "product_key") == [
        ("T1", 1, 100.0, 1, 1), ("T4", 2, 0.0, 5, 1), ("T5", 3, 100.0, 1, None),
    ]
    dead = deadletter.read(spark, tables.path("dead_letters"))
    assert rows(deadletter.count_by_batch(dead)) == [
        ("b_1", "Dedup", 1), ("b_1", "TypeCast", 1), ("b_1", "WriteStarSchema", 2),
    ]
    assert dead.where("_dlq_stage = 'TypeCast'").first().notional == "abc"

    second = feed(spark, trade("T4", "7.00"), trade("T6", product="P0"))
    pipeline.run_pipeline(second, tables.root, "b_2", "p")
    facts = pipeline.current_facts(spark, tables)
    assert rows(facts, "trade_id", "trade_key", "notional", "batch_id", "product_key") == [
        ("T1", 1, 100.0, "b_1", 1), ("T4", 4, 7.0, "b_2", 1), ("T5", 3, 100.0, "b_1", None),
        ("T6", 5, 100.0, "b_2", 2),
    ]
    assert rows(tables.read(spark, "dim_product"), "product_key", "product_id") == [(1, "P1"), (2, "P0")]
    assert tables.read(spark, "pipeline_runs").count() == 8
    assert tables.read(spark, "dq_scores").where("batch_id = 'b_1'").count() == 3
    assert tables.read(spark, "lineage_edges").where("batch_id = 'b_2'").count() == 29
    violations = tables.read(spark, "dq_violations").where("batch_id = 'b_1' AND rule_name = 'trade_id_not_null'")
    assert violations.first().row_key == "None"

    # the same batch again changes no measure
    before = rows(facts, "trade_id", "notional_usd", "running_notional_usd")
    pipeline.run_pipeline(second, tables.root, "b_3", "p")
    again = pipeline.current_facts(spark, tables)
    assert rows(again, "trade_id", "notional_usd", "running_notional_usd") == before


def test_unfinished_load_stays_invisible(spark, tables):
    pipeline.run_pipeline(feed(spark, trade("T1"), trade("T2")), tables.root, "b_1")
    store = FactStore(spark, tables)
    half = settle(store.current().drop("bucket", "load_id"))
    store.replace(half, 2)
    store.append(half, 2)
    assert pipeline.current_facts(spark, tables).count() == 2
    pipeline.run_pipeline(feed(spark, trade("T2", "9.00")), tables.root, "b_2")
    assert rows(pipeline.current_facts(spark, tables), "trade_id", "notional") == [("T1", 100.0), ("T2", 9.0)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def store_of(spark, tables, *loads):
    store = FactStore(spark, tables, buckets=8)
    for number, ids in enumerate(loads, 1):
        facts = spark.createDataFrame([(f"T{k}", number * 1000 + k, float(number)) for k in ids], "trade_id string, trade_key bigint, notional double")
        load_id = store.next_load()
        store.replace(facts, load_id)
        store.commit(load_id, f"b_{number}", store.append(facts, load_id))
    return store


def test_compaction_rewrites_touched_buckets_only(spark, tables):
    store = store_of(spark, tables, range(200), [3, 5], [5, 900])
    want = sorted([(f"T{k}", 1.0) for k in range(200) if k not in (3, 5)] + [("T3", 2.0), ("T5", 3.0), ("T900", 3.0)])
    assert rows(store.current(), "trade_id", "notional") == want
    before = {r.path for r in spark.read.format("binaryFile").load(f"{tables.path('fact_trades')}/bucket=*/load_id=*").select("path").collect()}
    hit = store.compact()
    assert 0 < len(hit) <= 2
    after = {r.path for r in spark.read.format("binaryFile").load(f"{tables.path('fact_trades')}/bucket=*/load_id=*").select("path").collect()}
    assert {p for p in before if not any(f"bucket={b}/" in p for b in hit)} == {p for p in after if not any(f"bucket={b}/" in p for b in hit)}
    assert all("load_id=4/" in p for p in after if any(f"bucket={b}/" in p for b in hit))
    assert rows(store.current(), "trade_id", "notional") == want
    assert tables.read(spark, "fact_replaced") is None and store.compact() == []
    assert store.next_load() == 5 and store.last_key() == 3900
    # later loads and another session go on from there
    again = FactStore(spark.newSession(), tables)
    ids = again.spark.createDataFrame([("T7", 5000, 9.0)], "trade_id string, trade_key bigint, notional double")
    again.replace(ids, 5)
    again.append(ids, 5)
    assert rows(store.current(), "trade_id", "notional") == want
    again.commit(5, "b_5", 5000)
    assert ("T7", 9.0) in rows(store.current(), "trade_id", "notional") and store.current().count() == len(want)


def test_compaction_that_dies_changes_nothing(spark, tables, monkeypatch):
    store = store_of(spark, tables, range(50), [3])
    want = rows(store.current(), "trade_id", "notional")
    monkeypatch.setattr(FactStore, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.compact()
    monkeypatch.undo()
    assert rows(store.current(), "trade_id", "notional") == want
    assert len(store.compact()) == 1 and rows(store.current(), "trade_id", "notional") == want


def test_current_facts_are_not_shuffled(spark, tables):
    store = store_of(spark, tables, range(200), [3, 5])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(store.current())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert "Exchange hashpartitioning" not in plan


def test_writes_count_their_rows(spark, tables):
    """Counts stand although every task fails once before it succeeds."""
    from pyspark import TaskContext

    def fails_once(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise ValueError("lost")

    source = spark.range(1000).repartition(5).mapInArrow(fails_once, "id long")
    written, seen = settle_counted(source, even=F.count_if(F.col("id") % 2 == 0))
    assert seen == {"rows": 1000, "even": 500} and written.count() == 1000


def test_run_has_no_counting_job(spark, tables, monkeypatch):
    def refuse(self):
        raise AssertionError("count() was called")

    monkeypatch.setattr(type(feed(spark)), "count", refuse)
    run = pipeline.run_pipeline(feed(spark, trade("T1"), trade("T1"), trade("T2", "abc"), trade("T3")), tables.root, "b_1")
    assert [r[4:8] for r in run.results] == [("SUCCESS", 4, 4, 0), ("SUCCESS", 4, 2, 2), ("SUCCESS", 2, 2, 0), ("SUCCESS", 2, 2, 0)]


def test_malformed_lines_and_unreadable_numbers_are_dead_letters(spark, tables, tmp_path):
    lines = [
        "trade_id,product_id,counterparty_id,asset_class,currency,direction,notional,quantity,trade_date,settlement_date,settlement_status,exchange",
        "T1,P1,CP001,FX,EUR,BUY,1.5,2,2026-05-20 00:00:00,2026-05-21 00:00:00,SETTLED,LSE",
        "T2,P1,CP001,FX,EUR,BUY,1.5,abc,2026-05-20 00:00:00,2026-05-21 00:00:00,SETTLED,LSE",
        "T3,P1,CP001,FX,EUR",
        "T4,P1,CP001,FX,EUR,BUY,1.5,2,2026-05-20 00:00:00,2026-05-21 00:00:00,SETTLED,LSE,more",
        "T5,P1,CP001,FX,EUR,BUY,1.5,,2026-05-20 00:00:00,2026-05-21 00:00:00,SETTLED,LSE",
        "T6,P1,CP001,FX,EUR,BUY,1.5,2,no date,2026-05-21 00:00:00,SETTLED,LSE",
    ]
    path = tmp_path / "trades_1.csv"
    path.write_text("\n".join(lines) + "\n")
    source = files.read_feed(spark, str(path), TRADES_CSV_SCHEMA, keep_malformed=True)
    run = pipeline.run_pipeline(source, tables.root, "b_1")
    assert [r[4:8] for r in run.results][:2] == [("SUCCESS", 6, 4, 2), ("SUCCESS", 4, 2, 2)]
    dead = deadletter.read(spark, tables.path("dead_letters"))
    assert rows(dead.where("_dlq_stage = 'Ingest'"), "raw_line", "_dlq_reason") == [(lines[3], "malformed_line"), (lines[4], "malformed_line")]
    assert dead.where("source_file LIKE '%trades_1.csv'").count() == 2
    assert rows(dead.where("_dlq_stage = 'TypeCast'"), "trade_id", "quantity", "trade_date") == [
        ("T2", "abc", "2026-05-20 00:00:00"), ("T6", "2", "no date"),
    ]
    assert rows(pipeline.current_facts(spark, tables), "trade_id", "quantity") == [("T1", 2.0), ("T5", 0.0)]
    with pytest.raises(ValueError):
        files.read_feed(spark, str(path), keep_malformed=True)


def test_rows_that_fail_rules_become_dead_letters(spark, tables):
    rules = [
        {"name": "named", "type": "null_check", "field": "exchange", "severity": "WARN", "stage": "post_clean"},
        {"name": "large", "type": "range_check", "field": "notional", "min": 10, "severity": "ERROR", "stage": "post_clean"},
        {"name": "known", "type": "null_check", "field": "product_id", "severity": "CRITICAL", "stage": "post_clean"},
    ]
    source = feed(spark, trade("T1"), trade("T2", "1.00"), trade("T3", "1.00", product=None), trade("T4", product=None))
    config = {"dead_letter_severities": {"clean": ["CRITICAL", "ERROR"]}}
    run = pipeline.run_pipeline(source, tables.root, "b_1", stages=["clean"], config=config, rules=rules)
    assert run.results[0][4:8] == ("SUCCESS", 4, 1, 3) and run.scores["post_clean"] < 100
    dead = deadletter.read(spark, tables.path("dead_letters"), "b_1")
    assert rows(dead, "trade_id", "_dlq_reason") == [
        ("T2", "dq_failed: large"), ("T3", "dq_failed: large,known"), ("T4", "dq_failed: known"),
    ]
    assert "dq_route" not in dead.columns


def test_failing_stage_keeps_its_input(spark, tables):
    broken = {"fx_convert": {"currency_col": "no_such_column"}}
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(feed(spark, trade("T1"), trade("T2")), tables.root, "b_1", config=broken)
    runs = tables.read(spark, "pipeline_runs").where("status = 'FAILED'").first()
    assert (runs.stage_name, runs.records_in, runs.records_out, runs.records_dead) == ("enrich", 2, 0, 2)
    assert deadletter.read(spark, tables.path("dead_letters"), "b_1").count() == 2
    assert tables.read(spark, "fact_trades") is None


def test_single_stage_starts_from_the_given_rows(spark, tables):
    run = pipeline.run_pipeline(feed(spark, trade("T1"), trade("T1")), tables.root, "b_1", stages=["clean"])
    assert [r[3:8] for r in run.results] == [("clean", "SUCCESS", 2, 1, 1)]


def test_source_that_cannot_be_read_is_recorded(spark, tables):
    bad = feed(spark, trade("T1")).withColumn("quantity", F.raise_error(F.lit("no such tape")).cast("double"))
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(bad, tables.root, "b_1")
    run = tables.read(spark, "pipeline_runs").first()
    assert (run.stage_name, run.status, run.records_dead) == ("ingest", "FAILED", 0)
    assert "no such tape" in run.note and "could not be kept" in run.note
    assert deadletter.read(spark, tables.path("dead_letters"), "b_1").count() == 0


def test_source_is_read_once(spark, tables):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = feed(spark, trade("T1"), trade("T2", "abc"), trade("T3")).mapInArrow(count, SCHEMA)
    pipeline.run_pipeline(source, tables.root, "b_1")
    assert seen.value == 3


def test_stored_score_counts_every_violation(spark, tables):
    many = [trade(f"T{k}", party=None) for k in range(1200)]
    pipeline.run_pipeline(feed(spark, *many), tables.root, "b_1", stages=["ingest"])
    stored = tables.read(spark, "dq_violations").count()
    assert stored >= 1200 and tables.read(spark, "dq_scores").first().total_violations == stored


def test_configured_steps_checkpoints_and_warnings(spark, tables):
    assert {"null_fill", "dedup", "fx_convert", "date_expand", "lei_lookup", "exposure_rollup", "position_net", "type_cast", "write_star"} <= set(registry.names())
    with pytest.raises(ValueError):
        registry.register("dedup")(lambda rows, options: rows)
    with pytest.raises(KeyError):
        registry.step("no_such_step")
    registry.register("desk")(lambda rows, options: rows.withColumn("desk", F.lit(options["name"])))
    try:
        config = {
            "extra_steps": {"clean": ["desk"]}, "desk": {"name": "D1"}, "checkpoints": {"clean": "book_ok"},
            "required_columns": {"clean": ["book"]},
        }
        rules = [{"name": "on_desk", "type": "null_check", "field": "desk", "stage": "book_ok"}]
        run = pipeline.run_pipeline(
            feed(spark, trade("T1")), tables.root, "b_1", stages=["ingest", "clean"], config=config, rules=rules
        )
    finally:
        del registry.STEPS["desk"]
    assert run.scores == {"book_ok": 100.0}
    assert run.results[1][10] == "missing columns: book"


def test_cast_and_load_are_steps(spark, tables):
    dead = tables.path("dead_letters")
    source = feed(spark, trade("T1"), trade("T2", "abc"))
    typed = registry.step("type_cast")(source, {"dead_letters": dead, "batch_id": "b_1"})
    assert rows(typed, "trade_id", "notional") == [("T1", 100.0)]
    assert rows(deadletter.read(spark, dead, "b_1"), "trade_id", "_dlq_stage") == [("T2", "TypeCast")]
    enriched = settle(pipeline.enrich_stage(typed))
    assert registry.step("write_star")(enriched, {"root": tables.root, "batch_id": "b_1"}) is enriched
    assert rows(pipeline.current_facts(spark, tables), "trade_id", "batch_id") == [("T1", "b_1")]


def test_latest_run_prunes_the_other_batches(spark, tables):
    for number in (1, 2):
        pipeline.run_pipeline(feed(spark, trade("T1", product=None)), tables.root, f"b_{number}", stages=["ingest", "clean"])
    runs = tables.read(spark, "pipeline_runs")
    for name in ("lineage_edges", "dq_violations"):
        found = lineage.of_latest_run(tables.read(spark, name), runs)
        assert rows(found.select("batch_id").distinct()) == [("b_2",)]
        assert "dynamicpruning" in plan_of(found).split("PartitionFilters")[1].split("]")[0]


def test_repeated_ids_become_rejects(spark, tables):
    same = [trade("T1", "1.00"), trade("T1", "2.00"), trade("T1", "3.00"), trade("T2")]
    run = pipeline.run_pipeline(feed(spark, *same), tables.root, "b_1", stages=["enrich", "load"],
                                config={"fx_convert": {}})
    assert rows(pipeline.current_facts(spark, tables), "trade_id") == [("T2",)]
    assert run.results[-1][7] == 3
    assert deadletter.read(spark, tables.path("dead_letters")).count() == 3


def test_batch_id_format():
    assert pipeline.new_batch_id(datetime(2026, 5, 20, 1, 2, 3)) == "b_20260520_010203"


def test_constraints_and_upsert(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1.0, "BUY"), ("b", 1.0, 1.0, None), (None, 1.0, 1.0, "BUY"), ("c", None, 1.0, "BUY"),
         ("d", 1.0, 1.0, "short")],
        "trade_id string, notional double, quantity double, direction string",
    )
    good, bad = star.split_by_constraints(df)
    assert rows(good, "trade_id") == [("a",), ("b",)]
    assert rows(bad, "constraint_reason") == [
        ("direction_not_allowed",), ("notional_missing",), ("trade_id_missing",),
    ]
    staged = df.where("trade_id = 'a'").withColumn("notional", F.lit(9.0))
    assert rows(star.upsert_facts(good, staged), "trade_id", "notional") == [("a", 9.0), ("b", 1.0)]


def test_feeds(spark, tmp_path):
    folder = str(tmp_path)
    df = feed(spark, trade("T1", None), trade("T2", "abc"))
    files.write_csv(df, f"{folder}/trades_20260519.csv")
    files.write_csv(df.limit(1), f"{folder}/trades_20260520.csv")
    newest = files.newest_feed(spark, folder)
    assert newest.endswith("trades_20260520.csv")
    assert files.read_feed(spark, newest, SCHEMA).first().notional is None
    assert files.newest_feed(spark, folder, "positions_") is None
    inferred = files.read_feed(spark, f"{folder}/trades_20260519.csv", infer=True)
    assert dict(inferred.dtypes)["quantity"] == "double"
    with pytest.raises(FileNotFoundError):
        files.read_feed(spark, f"{folder}/none.parquet")
    with pytest.raises(ValueError):
        files.read_feed(spark, f"{folder}/x.txt")


def test_stage_counts_accumulate_dead(spark):
    one = spark.createDataFrame([("b",)], "batch_id string")
    counts = observability.stage_counts(
        {"clean": {"in": [one], "dead": [one]}, "load": {"in": [one], "out": [one], "dead": [one]}}, ["batch_id"]
    )
    assert rows(counts, "stage_name", "records_in", "records_out", "records_dead", "records_dead_total") == [
        ("clean", 1, 0, 1, 1), ("load", 1, 1, 1, 2),
    ]
    assert clean.missing_columns(one, ["batch_id"]) == []


def test_rows_spread_for_a_load_are_shuffled_once(spark, tables):
    store = FactStore(spark, tables, 3)
    df = spark.range(300).select(F.concat(F.lit("T"), "id").alias("trade_id"), "id")
    keys = df.select("trade_id", (F.col("id") + 1).alias("trade_key"))
    out = store.spread(store.spread(df).join(keys.hint("shuffle_merge"), "trade_id").withColumn("load", F.lit(1)))
    assert plan_of(out).count("Exchange hashpartitioning") == 2  # the rows and the keys
    assert out.rdd.getNumPartitions() == 9 and out.count() == 300


def test_enrichment_is_shuffled_as_cleaned(spark):
    raw = feed(spark, *[trade(f"T{i}", str(i), "SELL" if i % 3 else "BUY", party=f"CP00{i % 4}") for i in range(40)], trade(None))
    cleaned = settle(pipeline.clean_stage(raw))
    config = {"fx_convert": {"rates_override": {"EUR": 2.0}}}
    out = pipeline.enrich_stage(cleaned, config)
    whole = pipeline.exposure.exposures(pipeline.attribute_stage(cleaned, config))
    assert out.columns == whole.columns and rows(out) == rows(whole)
    shuffled = out._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1].split("\n")[1]
    assert "exchange" in shuffled and "lei_code" not in shuffled and "fx_rate_to_usd" not in shuffled


def test_whole_rows_are_not_sorted_by_their_folders(spark, tables):
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    pipeline.run_pipeline(feed(spark, trade("T1"), trade("T1", "abc"), trade("T2", direction="x")), tables.root, "b_1", "p")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    plans = store.executionsList()
    plans = [plans.apply(i).physicalPlanDescription() for i in range(before, plans.size())]
    sorts = [part for plan in plans for part in plan.split("\n\n") if "Sort" in part.split("\n")[0] and "Arguments: [" in part]
    by = [part.split("Arguments: [")[1].split("#")[0] for part in sorts]
    assert "trade_id" in by and not {"_dlq_batch_id", "_dlq_stage", "_won", "stage"} & set(by)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_facts_are_spread_with_keys_for_names(spark):
    enriched = pipeline.enrich_stage(settle(pipeline.clean_stage(feed(spark, trade("T1"), trade("T2", product="P2")))))
    seen = []
    products, parties = settle(star.dim_product(enriched)), settle(star.dim_counterparty(enriched))
    facts = star.fact_trades(
        enriched, star.trade_keys(enriched), products, parties, "b", "p", lambda df: seen.append(df.columns) or df
    )
    assert rows(facts, "trade_id", "trade_key", "product_key") == [("T1", 1, 1), ("T2", 2, 2)]
    assert not {"product_id", "counterparty_id", "settlement_status", "trade_date"} & set(seen[0])


def test_members_are_made_distinct_by_hash(spark):
    trades = pipeline.attribute_stage(pipeline.clean_stage(feed(spark, trade("T1"), trade("T2"))))
    for members in (star.product_members(trades), star.counterparty_members(trades)):
        assert members.count() == 1 and "HashAggregate" in members._jdf.queryExecution().sparkPlan().toString().split("SortAggregate")[-1]
