import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import RULES
from tradeloom.operators import quality

NULL_RULE = {"name": "id_present", "type": "null_check", "field": "trade_id", "severity": "CRITICAL", "stage": "s"}


@pytest.fixture()
def two(spark):
    return spark.createDataFrame([("T1",), (None,)], "trade_id string")


def test_one_null_in_two_rows(two):
    score = quality.run_checkpoint(two, "s", [NULL_RULE]).first()
    assert (score.rules_run, score.rules_failed, score.total_violations, score.dq_score) == (1, 1, 1, 0.0)
    found = quality.violations(two, [NULL_RULE], "b1").first()
    assert (found.row_key, found.offending_value, found.batch_id) == ("None", None, "b1")


def test_range_flags_null_and_respects_one_sided_bounds(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 9.0), ("d", 2.0)], "trade_id string, v double")
    rule = {"name": "r", "type": "range_check", "field": "v", "stage": "s"}
    found = quality.violations(df, [{**rule, "min": 1}], "b")
    assert rows(found, "row_key", "offending_value") == [("a", "0.5"), ("b", "NULL")]
    assert rows(quality.violations(df, [{**rule, "max": 5}], "b"), "row_key") == [("b",), ("c",)]
    assert quality.violations(df, [rule], "b").count() == 0


def test_range_on_text_ignores_what_is_no_number(spark):
    df = spark.createDataFrame([("a", "abc"), ("b", "-1"), ("c", "3")], "trade_id string, v string")
    rule = {"name": "r", "type": "range_check", "field": "v", "min": 0, "stage": "s"}
    assert rows(quality.violations(df, [rule], "b"), "row_key") == [("b",)]


def test_references_ignore_case_and_nulls(spark):
    df = spark.createDataFrame([("a", "usd"), ("b", "XXX"), ("c", None)], "trade_id string, cur string")
    rule = {"name": "r", "type": "referential_integrity", "field": "cur", "stage": "s"}
    static = {**rule, "mode": "static_values", "allowed_values": ["USD"]}
    assert rows(quality.violations(df, [static], "b"), "row_key", "offending_value") == [("b", "XXX")]
    assert quality.violations(df, [{**static, "allowed_values": []}], "b").count() == 0
    assert quality.violations(df, [{**rule, "mode": "other"}], "b").count() == 0
    lookup = {**rule, "mode": "table", "lookup_table": "t", "lookup_field": "code"}
    table = spark.createDataFrame([("Usd",), ("Usd",), (None,)], "code string")
    assert rows(quality.violations(df, [lookup], "b", {"t": table}), "row_key") == [("b",)]
    assert quality.violations(df, [lookup], "b", {"t": table.limit(0)}).count() == 0
    assert quality.violations(df, [lookup], "b").count() == 0


def test_cross_field_passes_nulls_bad_expressions_and_missing_fields(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 5, None), ("c", None, "7")], "trade_id string, n int, t string")
    rule = {"name": "r", "type": "cross_field", "fields": ["n", "t"], "stage": "s"}
    found = quality.violations(df, [{**rule, "expr": "n > 2"}], "b")
    assert rows(found, "row_key", "severity", "field_name", "offending_value") == [("a", "WARN", "n, t", "n=1, t=x")]
    for text in ("no_such_column > 1", "n >", None):
        assert quality.violations(df, [{**rule, "expr": text}], "b").count() == 0
    assert quality.violations(df, [{**rule, "fields": ["zz"], "expr": "n > 2"}], "b").count() == 0
    # a value that cannot be cast inside the expression is null, so it passes
    assert rows(quality.violations(df, [{**rule, "expr": "CAST(t AS INT) < 7"}], "b"), "row_key") == [("c",)]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_rule_that_cannot_run_reports_itself(spark):
    df = spark.createDataFrame([("a", [1])], "trade_id string, v array<int>")
    rule = {"name": "r", "type": "range_check", "field": "v", "min": 1, "severity": "WARN", "stage": "s"}
    found = quality.violations(df, [rule], "b").first()
    assert found.offending_value.startswith("RULE_EXECUTION_ERROR: ") and found.row_key is None
    assert quality.rule_counts(df, [rule]).first().failing_rows == 1


def test_faulty_rules_are_isolated(two):
    base = {"type": "range_check", "stage": "s", "severity": "WARN"}
    faulty = [
        {**base, "name": "no_field"}, {**base, "name": "bad_bound", "field": "trade_id", "min": "abc"},
        {"name": "lookup", "type": "referential_integrity", "mode": "table", "lookup_table": "t", "lookup_field": "code", "stage": "s"},
    ]
    table = two.sparkSession.createDataFrame([("A",)], "code string")
    found = quality.violations(two, [*faulty, NULL_RULE], "b", {"t": table})
    assert rows(found, "rule_name", "severity") == [
        ("bad_bound", "ERROR"), ("id_present", "CRITICAL"), ("lookup", "ERROR"), ("no_field", "ERROR"),
    ]
    assert quality.run_checkpoint(two, "s", [*faulty, NULL_RULE], {"t": table}).first().total_violations == 4


def test_score_counts_all_rows_and_skips(spark):
    df = spark.range(1500).select(F.lit(None).cast("string").alias("trade_id"))
    counts = quality.rule_counts(df, [NULL_RULE, {**NULL_RULE, "name": "absent", "field": "zz"}])
    assert rows(counts, "rule_name", "failing_rows", "skipped") == [("absent", 0, True), ("id_present", 1500, False)]
    score = quality.checkpoint_scores(counts).first()
    assert (score.total_violations, score.rules_passed, score.rules_skipped, score.dq_score) == (1500, 1, 1, 0.0)
    assert quality.checkpoint_scores(counts, per_rule=1000).first().total_violations == 1000
    found = quality.violations(df.withColumn("k", F.lit(1)), [NULL_RULE], "b")
    assert quality.first_violations(found, 1000).count() == 1000 and found.count() == 1500
    assert quality.first_violations(found, 3).count() == 3


def test_score_formula(spark):
    counts = spark.createDataFrame(
        [("s", "a", "CRITICAL", 1, False), ("s", "b", "ERROR", 1, False), ("s", "c", "WARN", 1, False),
         ("s", "d", "INFO", 4, False), ("s", "e", "WARN", 0, False)],
        "checkpoint string, rule_name string, severity string, failing_rows bigint, skipped boolean",
    )
    score = quality.checkpoint_scores(counts).first()
    assert score.dq_score == 55.0 and score.total_violations == 7 and score.rules_failed == 4


def test_rule_lists(tmp_path):
    assert len(RULES) == 21 and len(quality.rules_for("post_ingest")) == 9
    assert quality.rule_names()[0] == "trade_id_not_null"
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": [NULL_RULE]}))
    assert quality.load_rules(str(path)) == [NULL_RULE]
    for bad in ({"type": "null_check"}, {"name": "x"}, {"name": "x", "type": "y"}):
        with pytest.raises(ValueError):
            quality.validate_rules([bad])


def test_run_all_orders_by_checkpoint(two):
    checkpoints = {r.checkpoint for r in quality.run_all(two).collect()}
    assert checkpoints == {"post_ingest", "post_clean", "pre_load"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


FRESH = {"name": "fresh", "type": "freshness", "field": "d", "source": "src", "as_of": "2026-05-20", "max_age_days": 2, "stage": "s"}


def test_freshness_reports_each_stale_source_once(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2026-05-18", None), ("a", "2020-01-01", "T1"), ("b", "2026-05-17", "T2"), ("b", "2026-05-16", "T3"), (None, "2026-05-01", "T4"),
         ("c", None, "T5"), ("c", "no date", "T6")],
        "src string, d string, trade_id string",
    )
    rules = [FRESH, {**NULL_RULE, "stage": "s"}, {**FRESH, "name": "none", "source": "zz"}, {**FRESH, "name": "bad", "max_age_days": "x"}]
    evaluation = quality.evaluate(df, rules, "b1")
    evaluation.violations.write.parquet(str(tmp_path / "v"))
    found = spark.read.parquet(str(tmp_path / "v"))
    assert rows(found.where("rule_name = 'fresh'"), "row_key", "offending_value", "severity", "field_name", "batch_id") == [
        ("None", "2026-05-01 00:00:00", "ERROR", "d", "b1"), ("b", "2026-05-17 00:00:00", "ERROR", "d", "b1"), ("c", "NULL", "ERROR", "d", "b1"),
    ]
    assert found.where("rule_name = 'id_present'").count() == 1 and found.where("rule_name = 'bad'").first().offending_value.startswith("RULE_EX")
    want = [("bad", 1, False), ("fresh", 3, False), ("id_present", 1, False), ("none", 0, True)]
    assert rows(evaluation.counts(spark), "rule_name", "failing_rows", "skipped") == want
    assert rows(quality.rule_counts(df, rules), "rule_name", "failing_rows", "skipped") == want
    assert quality.run_checkpoint(df, "s", rules).first().total_violations == 5
    by = quality.rule_counts(df.withColumn("k", F.col("src") == "a"), [FRESH], by=["k"])
    assert rows(by, "k", "failing_rows") == [(False, 2), (None, 1), (True, 0)]


def test_violations_are_counted_by_the_scan_that_writes_them(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("trade_id")).write.parquet(path)
    evaluation = quality.evaluate(spark.read.parquet(path), [NULL_RULE], "b")
    plan = plan_of(evaluation.violations)
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    evaluation.violations.write.parquet(str(tmp_path / "v"))
    assert evaluation.counts(spark).first().failing_rows == 334


def test_routes_take_the_worst_severity(spark, tmp_path):
    rules = [
        {"name": "w", "type": "range_check", "field": "n", "min": 1, "severity": "WARN", "stage": "s"},
        {"name": "e", "type": "range_check", "field": "n", "min": 3, "severity": "ERROR", "stage": "s"},
        {"name": "i", "type": "range_check", "field": "n", "max": 8, "severity": "INFO", "stage": "s"},
        {"name": "absent", "type": "null_check", "field": "zz", "severity": "CRITICAL", "stage": "s"}, FRESH,
    ]
    path = str(tmp_path / "rows")
    spark.createDataFrame([(0,), (2,), (5,), (9,), (None,)], "n int").write.parquet(path)
    df = spark.read.parquet(path)
    routed = quality.routed(df, rules)
    assert rows(routed, "n", "dq_route", "dq_rules") == [
        (0, "ERROR", "w,e"), (2, "ERROR", "e"), (5, "PASS", ""), (9, "OTHER", "i"), (None, "ERROR", "w,e,i"),
    ]
    plan = plan_of(routed)
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    kept, dead, left = quality.settle_routed(df, rules, ["ERROR"])
    assert (left, kept.count(), dead.count()) == (2, 2, 3)
    assert "PartitionFilters: [isnotnull(dq_route" in plan_of(dead) or "PartitionFilters: [dq_route" in plan_of(dead)
    assert rows(quality.routed(df, []), "dq_route", "dq_rules") == [("PASS", "")] * 5


def test_export_is_one_order_over_numbered_files(spark, tmp_path):
    stored, path = str(tmp_path / "v"), str(tmp_path / "csv")
    df = spark.range(400).select(
        F.lit("b").alias("batch_id"), F.lit("s").alias("stage"), F.concat(F.lit("r"), F.col("id") % 3).alias("rule_name"),
        F.lit("WARN").alias("severity"), F.lit("f").alias("field_name"), F.when(F.col("id") % 5 > 0, F.lit('a "b", c')).alias("offending_value"),
        F.col("id").cast("string").alias("row_key"), F.timestamp_add("DAY", (F.col("id") % 10).cast("int"), F.lit("2026-05-01").cast("timestamp_ntz")).alias("ts"),
    )
    quality.dated(df).write.partitionBy("run_date").parquet(stored)
    found = spark.read.parquet(stored)
    plan = plan_of(found.where(F.col("run_date").between("2026-05-02", "2026-05-04")))
    assert "PartitionFilters: [isnotnull(run_date" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        quality.export_csv(found, path, "2026-05-02", "2026-05-04")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    names = sorted(r.path for r in spark.read.format("binaryFile").load(f"{path}/*.csv").select("path").collect())
    assert len(names) > 2
    schema = "run_date date, batch_id string, rule_name string, severity string, field_name string, offending_value string, row_key string, stage string, ts timestamp_ntz"
    parts = [[tuple(r[c] for c in ("run_date", "rule_name", "row_key")) for r in spark.read.schema(schema).csv(n, header=True).collect()] for n in names]
    whole = [r for part in parts for r in part]
    assert len(whole) == 120 and whole == sorted(whole)
    same = spark.read.schema(schema).csv(path, header=True).select(*df.columns)
    chosen = df.where("ts >= '2026-05-02' AND ts < '2026-05-05'")
    assert rows(same) == rows(chosen)


def test_only_rows_that_break_a_rule_build_violations(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", -1), ("d", None)], "trade_id string, v int")
    rules = [{"name": "there", "type": "null_check", "field": "v", "stage": "s"},
             {"name": "low", "type": "range_check", "field": "v", "min": 0, "stage": "s"}]
    evaluation = quality.evaluate(df, rules, "b")
    found = evaluation.violations
    assert rows(found, "row_key", "rule_name") == [("a", "low"), ("a", "there"), ("c", "low"), ("d", "low"), ("d", "there")]
    assert rows(evaluation.counts(spark), "rule_name", "failing_rows") == [("low", 3), ("there", 2)]
    below = plan_of(found).split("Generate")[1].strip().split("\n")[1]
    assert "Filter" in below
