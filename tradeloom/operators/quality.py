"""Declarative data-quality rules evaluated together in one scan.

Every rule becomes one boolean column expression. Violations are the exploded
array of the rules that a row breaks; scores come from one aggregation of the
same expressions. The number of rules does not change the number of scans. Rules
over an aggregate (freshness) read their two columns once more and add their
violations to the same result.
"""

import json
import threading
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import (
    NAMED_EXPRESSIONS,
    RULES,
    SEVERITY_WEIGHTS,
)
from tradeloom.functions.staging import settle, settle_counted, watched

RULE_TYPES = ("null_check", "range_check", "referential_integrity", "cross_field", "freshness")
TABLE_MODES = ("table", "duckdb_table")
DEFAULT_SEVERITY = {"cross_field": "WARN"}
#: Routes of checked rows, best first; a row takes the worst severity that it breaks.
ROUTES = ("PASS", "OTHER", "WARN", "ERROR", "CRITICAL")
_PLANNING = threading.RLock()


# --- rule lists --------------------------------------------------------------

def validate_rules(rules: Sequence[Mapping]) -> list[Mapping]:
    """Raise ValueError for a rule without name or with a missing or unknown type."""
    for rule in rules:
        if "name" not in rule:
            raise ValueError(f"rule without a name: {rule}")
        if "type" not in rule:
            raise ValueError(f"rule {rule['name']!r} has no type")
        if rule["type"] not in RULE_TYPES:
            raise ValueError(f"rule {rule['name']!r}: type {rule['type']!r} is not in {RULE_TYPES}")
    return list(rules)


def load_rules(path: str) -> list[Mapping]:
    """Rules from a JSON or YAML file with a top-level ``rules`` list."""
    with open(path) as handle:
        text = handle.read()
    if path.endswith(".json"):
        return validate_rules(json.loads(text).get("rules", []))
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading YAML rules needs the yaml package; use JSON") from error
    return validate_rules(yaml.safe_load(text).get("rules", []))


def rules_for(checkpoint: str, rules: Sequence[Mapping] = RULES) -> list[Mapping]:
    return [r for r in rules if r.get("stage") == checkpoint]


def rule_names(rules: Sequence[Mapping] = RULES) -> list[str]:
    return [r["name"] for r in rules]


# --- rules as expressions ----------------------------------------------------

@dataclass
class Check:
    """One rule as columns. ``broken`` is never null, and false on rows if the rule has ``groups``.

    ``groups`` has one row per violation of a rule over an aggregate: row_key, offending,
    and the columns that violations and counts are grouped by.
    """

    rule: Mapping
    broken: Column
    offending: Column
    skipped: bool = False
    error: str | None = None
    groups: DataFrame | None = None

    @property
    def severity(self) -> str:
        return self.rule.get("severity", DEFAULT_SEVERITY.get(self.rule["type"], "ERROR"))

    @property
    def stage(self) -> str:
        return self.rule.get("stage", "unknown")

    @property
    def field_name(self) -> str:
        if self.rule["type"] == "cross_field" and not self.error:
            return ", ".join(self.rule.get("fields", []))
        return self.rule.get("field") or [*self.rule.get("fields", []), "unknown"][0]


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _number(df: DataFrame, field: str) -> Column:
    """The field as a number; text that is none compares as null."""
    is_text = df.schema[field].dataType.typeName() == "string"
    return F.col(field).try_cast("double") if is_text else F.col(field)


@contextmanager
def _lenient(spark: SparkSession):
    """Bad casts inside a user's expression give null, so the row passes.

    The mode is fixed in an expression when it is analysed, which happens inside.
    The setting belongs to the whole session: rules are compiled by one thread at
    a time, and other threads should not plan queries of this session meanwhile.
    """
    with _PLANNING:
        before = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            yield
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)


def _pass(rule: Mapping) -> Check:
    return Check(rule, F.lit(False), F.lit(None).cast("string"), skipped=True)


def _null_check(df: DataFrame, rule: Mapping) -> Check:
    return Check(rule, F.col(rule["field"]).isNull(), F.lit(None).cast("string"))


def _range_check(df: DataFrame, rule: Mapping) -> Check:
    low, high = rule.get("min"), rule.get("max")
    if low is None and high is None:
        return _pass(rule)
    raw, number = F.col(rule["field"]), _number(df, rule["field"])
    broken = raw.isNull()
    if low is not None:
        broken = broken | _true(number < F.lit(float(low)))
    if high is not None:
        broken = broken | _true(number > F.lit(float(high)))
    return Check(rule, broken, F.coalesce(raw.cast("string"), F.lit("NULL")))


def _static_reference(df: DataFrame, rule: Mapping) -> Check:
    allowed = [str(v).upper() for v in rule.get("allowed_values", [])]
    if not allowed:
        return _pass(rule)
    value = F.col(rule["field"])
    broken = value.isNotNull() & ~_true(F.upper(value).isin(allowed))
    return Check(rule, broken, value.cast("string"))


def _cross_field(df: DataFrame, rule: Mapping) -> Check:
    text = rule.get("expr") or NAMED_EXPRESSIONS.get(rule.get("expr_alias", ""))
    fields = rule.get("fields", [])
    if not text or not set(fields) <= set(df.columns):
        return _pass(rule)
    offending = F.concat_ws(
        ", ",
        *[
            F.concat(F.lit(f"{f}="), F.coalesce(F.col(f).cast("string"), F.lit("None")))
            for f in fields
        ],
    )
    return Check(rule, _true(~F.expr(text)), offending)


def _freshness(df: DataFrame, rule: Mapping, by: Sequence[str]) -> Check:
    """Sources whose newest date is older than allowed, or that have none.

    ``field`` is the date, ``source`` the column that names the source; the newest date is
    held against ``as_of`` (the current time if absent) less ``max_age_days`` (0).
    """
    source, field = rule.get("source"), rule["field"]
    if source not in df.columns:
        return _pass(rule)
    text = df.schema[field].dataType.typeName() == "string"
    date = F.col(field).try_cast("timestamp_ntz") if text else F.col(field).cast("timestamp_ntz")
    now = F.lit(str(rule["as_of"])) if rule.get("as_of") is not None else F.current_timestamp()
    oldest = now.cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(int(rule.get("max_age_days", 0))))
    newest = df.groupBy(*by, F.col(source).alias("_source")).agg(F.max(date).alias("_newest"))
    stale = newest.where(F.col("_newest").isNull() | (F.col("_newest") < oldest)).select(
        *by,
        F.coalesce(F.col("_source").cast("string"), F.lit("None")).alias("_row_key"),
        F.coalesce(F.col("_newest").cast("string"), F.lit("NULL")).alias("_offending"),
    )
    return replace(_pass(rule), skipped=False, groups=stale)


def _compile(df: DataFrame, rule: Mapping, by: Sequence[str] = ()) -> Check:
    """Build and analyse one rule; a rule that cannot be analysed is isolated."""
    kind = rule["type"]
    try:
        if kind != "cross_field" and rule["field"] not in df.columns:
            return _pass(rule)
        if kind == "null_check":
            check = _null_check(df, rule)
        elif kind == "range_check":
            check = _range_check(df, rule)
        elif kind == "cross_field":
            check = _cross_field(df, rule)
        elif kind == "freshness":
            return _freshness(df, rule, by)
        elif rule.get("mode", "static_values") == "static_values":
            check = _static_reference(df, rule)
        else:
            return _pass(rule)
        df.select(check.broken, check.offending)
        return check
    except Exception as error:
        if kind == "cross_field" and isinstance(error, (AnalysisException, ParseException)):
            return _pass(rule)
        return _broken_rule(rule, error)


def _broken_rule(rule: Mapping, error: Exception) -> Check:
    """A rule that cannot run; it reports itself as one ERROR violation."""
    text = f"RULE_EXECUTION_ERROR: {type(error).__name__}: {error}"
    return replace(_pass({**rule, "severity": "ERROR"}), skipped=False, error=text)


def _with_lookups(
    df: DataFrame, rules: Sequence[Mapping], tables: Mapping[str, DataFrame]
) -> tuple[DataFrame, dict[str, Column]]:
    """Join the distinct allowed values of every table-lookup rule to the rows."""
    broken: dict[str, Column] = {}
    for i, rule in enumerate(rules):
        is_lookup = rule["type"] == "referential_integrity" and rule.get("mode") in TABLE_MODES
        lookup = tables.get(rule.get("lookup_table")) if is_lookup else None
        if lookup is None or rule.get("lookup_field") not in lookup.columns:
            continue
        if rule.get("field") not in df.columns:
            continue
        allowed = F.upper(F.col(rule["lookup_field"]).cast("string"))
        values = settle(
            lookup.select(allowed.alias(f"_allowed_{i}"))
            .where(F.col(f"_allowed_{i}").isNotNull())
            .distinct(),
            "allowed",
        )
        if values.isEmpty():
            continue
        key = F.upper(F.col(rule["field"]).cast("string"))
        df = df.join(values, key == F.col(f"_allowed_{i}"), "left")
        broken[rule["name"]] = F.col(rule["field"]).isNotNull() & F.col(f"_allowed_{i}").isNull()
    return df, broken


def compile_rules(
    df: DataFrame,
    rules: Sequence[Mapping],
    tables: Mapping[str, DataFrame] | None = None,
    by: Sequence[str] = (),
) -> tuple[DataFrame, list[Check]]:
    """The rows to scan (with lookup columns, if any) and one Check per rule.

    Rules over an aggregate are evaluated for each group of the columns ``by``.
    """
    validate_rules(rules)
    joined, lookups = _with_lookups(df, rules, tables or {})
    checks = []
    with _lenient(df.sparkSession):
        for i, rule in enumerate(rules):
            if rule["name"] in lookups:
                value = F.col(rule["field"]).cast("string")
                checks.append(Check(rule, lookups[rule["name"]], value))
                continue
            check = _compile(df, rule, by)
            if rule["type"] == "cross_field" and not check.skipped:
                # adding the column analyses the user's expression while casts are lenient
                joined = joined.withColumn(f"_broken_{i}", check.broken)
                check = replace(check, broken=F.col(f"_broken_{i}"))
            checks.append(check)
    return joined, checks


# --- violations --------------------------------------------------------------

VIOLATION_COLUMNS = [
    "batch_id", "rule_name", "severity", "field_name", "offending_value", "row_key", "stage", "ts",
]


@dataclass
class Evaluation:
    """The violations of a checkpoint, and its counts once they have been written."""

    violations: DataFrame
    checks: list[Check]
    rows: Observation | None
    groups: dict[int, Observation]

    def counts(self, spark: SparkSession) -> DataFrame:
        """``rule_counts`` as the write of the violations counted them: one row per rule."""
        seen = self.rows.get if self.rows else {}
        found = [
            (c.stage, c.rule["name"], c.severity,
             1 if c.error else self.groups[i].get["rows"] if i in self.groups else seen.get(f"_n{i}", 0), c.skipped)
            for i, c in enumerate(self.checks)
        ]
        return spark.createDataFrame(found, COUNTS_SCHEMA)


def evaluate(
    df: DataFrame,
    rules: Sequence[Mapping],
    batch_id: str | Column,
    tables: Mapping[str, DataFrame] | None = None,
    ts: Column | None = None,
    counting: bool = True,
) -> Evaluation:
    """One row per broken rule and input row, all of them, from one scan.

    With ``counting`` the job that writes the violations also counts each rule's. A rule
    over an aggregate has one violation per group; it has no row, hence no ``ts`` of a row.
    """
    scan, checks = compile_rules(df, rules, tables)
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    when = F.current_timestamp() if ts is None else ts
    plain = F.lit(batch_id if isinstance(batch_id, str) else None).cast("string")
    alone = when if ts is None else F.lit(None).cast("timestamp")
    found, hits, parts, groups, rows = [], {}, [], {}, None
    for i, check in enumerate(checks):
        key = check.rule.get("row_key_col", "trade_id")
        row_key = (
            F.coalesce(F.col(key).cast("string"), F.lit("None"))
            if key in df.columns
            else F.lit(None).cast("string")
        )
        if check.groups is not None:
            stale = check.groups
            if counting:
                stale, groups[i] = watched(stale)
            report = F.inline(F.array(_violation(check, F.col("_offending"), F.col("_row_key"))))
            parts.append(stale.select(plain.alias("batch_id"), alone.alias("ts"), report))
        elif not check.skipped and not check.error:
            hits[f"_n{i}"] = check.broken
            found.append(F.when(F.col(f"_n{i}"), _violation(check, check.offending, row_key)))
    if found:
        scan = scan.withColumns(hits)
        if counting:
            scan, rows = watched(scan, **{n: F.count_if(F.col(n)) for n in hits})
        # most rows break no rule; the array is made for the others only
        scan = scan.where(F.greatest(F.lit(False), *hits))
        broken = F.inline(F.array_compact(F.array(*found)))
        parts.insert(0, scan.select(batch.alias("batch_id"), when.alias("ts"), broken))
    failed = [c for c in checks if c.error]
    if failed:
        # a rule that cannot run reports itself once
        reports = F.array(*[_violation(c, F.lit(c.error), F.lit(None).cast("string")) for c in failed])
        parts.append(df.sparkSession.range(1).select(plain.alias("batch_id"), alone.alias("ts"), F.inline(reports)))
    if not parts:
        empty = F.lit(None).cast("string")
        parts.append(scan.limit(0).select(*[(when if c == "ts" else empty).alias(c) for c in VIOLATION_COLUMNS]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return Evaluation(out.select(*VIOLATION_COLUMNS), checks, rows, groups)


def violations(
    df: DataFrame,
    rules: Sequence[Mapping],
    batch_id: str | Column,
    tables: Mapping[str, DataFrame] | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """The violations of ``evaluate``."""
    return evaluate(df, rules, batch_id, tables, ts, counting=False).violations


def routed(
    df: DataFrame, rules: Sequence[Mapping], tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Every row with the worst severity of the rules it breaks and their names.

    ``dq_route`` is one of ROUTES; ``dq_rules`` lists the broken rules in their order. The
    array of broken rules is reduced in the row, so that no key is joined. Rules over an
    aggregate, and rules that cannot run, route no row.
    """
    scan, checks = compile_rules(df, rules, tables)
    found = [
        F.when(
            c.broken,
            F.struct(
                F.lit(ROUTES.index(c.severity) if c.severity in ROUTES[1:] else 1).alias("worse"),
                F.lit(c.rule["name"]).alias("rule_name"),
            ),
        )
        for c in checks
        if not c.skipped and not c.error and c.groups is None
    ]
    if not found:
        return scan.select(*df.columns, F.lit(ROUTES[0]).alias("dq_route"), F.lit("").alias("dq_rules"))
    broken = scan.withColumn("_broken", F.array_compact(F.array(*found)))
    worst = F.coalesce(F.array_max(F.transform("_broken", lambda b: b["worse"])), F.lit(0))
    return broken.select(
        *df.columns,
        F.element_at(F.array(*map(F.lit, ROUTES)), worst + 1).alias("dq_route"),
        F.array_join(F.transform("_broken", lambda b: b["rule_name"]), ",").alias("dq_rules"),
    )


def settle_routed(
    df: DataFrame, rules: Sequence[Mapping], dead: Sequence[str], tables: Mapping[str, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """``routed``, written once in folders by route: (rows that stay, rows of the routes ``dead``, how many stay).

    Both sides only read their folders.
    """
    bad = F.col("dq_route").isin(list(dead))
    rows, seen = settle_counted(routed(df, rules, tables), "routed", ["dq_route"], left=F.count_if(~bad))
    return rows.where(~bad), rows.where(bad), seen["left"]


def _violation(check: Check, offending: Column, row_key: Column) -> Column:
    return F.struct(
        F.lit(check.rule["name"]).alias("rule_name"),
        F.lit(check.severity).alias("severity"),
        F.lit(check.field_name).alias("field_name"),
        offending.alias("offending_value"),
        row_key.alias("row_key"),
        F.lit(check.stage).alias("stage"),
    )


def first_violations(found: DataFrame, per_rule: int) -> DataFrame:
    """The ``per_rule`` violations of each rule with the lowest row keys: a top-n report.

    Only that many rows of a rule leave each map task: the optimizer limits the
    window group before the shuffle.
    """
    order = [F.col(c).asc_nulls_first() for c in ("row_key", "offending_value", "field_name")]
    window = Window.partitionBy("batch_id", "stage", "rule_name").orderBy(*order)
    return found.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= per_rule).drop("_rank")


# --- counts and scores -------------------------------------------------------

COUNTS_SCHEMA = "checkpoint string, rule_name string, severity string, failing_rows bigint, skipped boolean"


def rule_counts(
    df: DataFrame,
    rules: Sequence[Mapping],
    tables: Mapping[str, DataFrame] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Broken rows per rule, including rules nobody breaks, in one aggregation.

    A rule over an aggregate counts its groups, in a small aggregation of its own.
    """
    scan, checks = compile_rules(df, rules, tables, by)

    def row(check: Check, failing: Column) -> Column:
        return F.struct(
            F.lit(check.stage).alias("checkpoint"),
            F.lit(check.rule["name"]).alias("rule_name"),
            F.lit(check.severity).alias("severity"),
            failing.alias("failing_rows"),
            F.lit(check.skipped).alias("skipped"),
        )

    of_rows = [c for c in checks if c.groups is None]
    sums = [F.count_if(F.lit(False) if c.error else c.broken).alias(f"_n{i}") for i, c in enumerate(of_rows)]
    out = None
    if of_rows:
        rows = F.array(
            *[row(c, F.lit(1).cast("bigint") if c.error else F.col(f"_n{i}")) for i, c in enumerate(of_rows)]
        )
        out = scan.groupBy(*by).agg(*sums).select(*by, F.inline(rows))
    for check in (c for c in checks if c.groups is not None):
        stale = check.groups.select(*by, F.lit(1).alias("_one"))
        if by:  # groups without a stale source count as well
            stale = stale.unionByName(df.select(*by, F.lit(0).alias("_one")).distinct())
        counts = stale.groupBy(*by).agg(F.coalesce(F.sum("_one"), F.lit(0)).alias("_n"))
        part = counts.select(*by, F.inline(F.array(row(check, F.col("_n")))))
        out = part if out is None else out.unionByName(part)
    return out


def checkpoint_scores(
    counts: DataFrame, by: Sequence[str] = (), per_rule: int | None = None
) -> DataFrame:
    """Score from 0 to 100 per checkpoint; with ``per_rule`` a rule counts that many rows at most.

    The penalty is the weighted number of violating rows over twice the number
    of rules, so a few hundred bad rows already give 0.
    """
    counted = F.col("failing_rows")
    if per_rule is not None:
        counted = F.least(counted, F.lit(per_rule))
    rows = counts.withColumn("_v", counted)

    def of(severity: str) -> Column:
        return F.sum(F.when(F.col("severity") == severity, F.col("_v")).otherwise(0))

    totals = rows.groupBy(*by, "checkpoint").agg(
        F.count("*").alias("rules_run"),
        F.count_if(F.col("_v") == 0).alias("rules_passed"),
        F.count_if(F.col("_v") > 0).alias("rules_failed"),
        F.count_if("skipped").alias("rules_skipped"),
        F.sum("_v").alias("total_violations"),
        of("CRITICAL").alias("critical_count"),
        of("ERROR").alias("error_count"),
        of("WARN").alias("warn_count"),
    )
    penalty = (
        F.col("critical_count") * SEVERITY_WEIGHTS["CRITICAL"]
        + F.col("error_count") * SEVERITY_WEIGHTS["ERROR"]
        + F.col("warn_count") * SEVERITY_WEIGHTS["WARN"]
    )
    share = penalty / (F.col("rules_run") * SEVERITY_WEIGHTS["CRITICAL"])
    score = F.bround(F.greatest(F.lit(0.0), F.lit(100.0) * (F.lit(1.0) - share)), 2)
    return totals.withColumn("dq_score", score)


def run_checkpoint(
    df: DataFrame,
    checkpoint: str,
    rules: Sequence[Mapping] = RULES,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Score of one checkpoint; a checkpoint without rules scores nothing."""
    return checkpoint_scores(rule_counts(df, rules_for(checkpoint, rules), tables))


def run_all(
    df: DataFrame,
    rules: Sequence[Mapping] = RULES,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Scores of every checkpoint on one DataFrame, from one scan."""
    return checkpoint_scores(rule_counts(df, rules, tables))


# --- queries over stored violations and scores -------------------------------

def query_violations(
    found: DataFrame,
    batch_id: str | None = None,
    severity: str | None = None,
    stage: str | None = None,
    rule_name: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Violations, latest first, with optional filters; all of them unless ``limit`` is given."""
    wanted = {
        "batch_id": batch_id,
        "severity": severity.upper() if severity else None,
        "stage": stage,
        "rule_name": rule_name,
    }
    for column, value in wanted.items():
        if value:
            found = found.where(F.col(column) == value)
    ties = ["batch_id", "rule_name", "row_key", "offending_value", "field_name"]
    ordered = found.orderBy(F.col("ts").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties])
    return ordered if limit is None else ordered.limit(limit)


EXPORT_ORDER = ["run_date", "batch_id", "stage", "rule_name", "row_key", "offending_value", "field_name"]


def dated(found: DataFrame, ts: Column | None = None) -> DataFrame:
    """Violations with the day by which they are stored."""
    return found.withColumn("run_date", F.to_date(F.col("ts") if ts is None else ts))


def export_csv(found: DataFrame, path: str, first_day: str, last_day: str) -> None:
    """Stored violations of some days as CSV: numbered files with headers, in order among themselves.

    Only the folders of those days are read; the rows are range-partitioned, so any number
    of tasks write the one order.
    """
    order = [F.col(c).asc_nulls_first() for c in EXPORT_ORDER]
    chosen = found.where(F.col("run_date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    rows = chosen.select("run_date", *VIOLATION_COLUMNS).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.option("header", True).csv(path)


def violation_summary(found: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Violations per rule and severity, worst severity first."""
    if batch_id:
        found = found.where(F.col("batch_id") == batch_id)
    rank = (
        F.when(F.col("severity") == "CRITICAL", 1)
        .when(F.col("severity") == "ERROR", 2)
        .when(F.col("severity") == "WARN", 3)
        .otherwise(4)
    )
    return (
        found.groupBy("rule_name", "severity")
        .agg(F.count("*").alias("violation_count"))
        .withColumn("severity_rank", rank)
        .orderBy("severity_rank", F.desc("violation_count"), "rule_name")
    )


def latest_scores(scores: DataFrame, limit: int | None = None) -> DataFrame:
    """Scores, newest first; all of them unless ``limit`` is given."""
    ordered = scores.orderBy(F.col("recorded_at").desc_nulls_last(), "batch_id", "checkpoint")
    return ordered if limit is None else ordered.limit(limit)


def score_trend(scores: DataFrame) -> DataFrame:
    """All scores, newest first."""
    return scores.select(
        "batch_id", "checkpoint", "dq_score", "rules_run", "rules_passed", "rules_failed",
        "total_violations", "critical_count", "error_count", "warn_count", "recorded_at",
    ).orderBy(F.col("recorded_at").desc_nulls_last())


def scorecard(scores: DataFrame) -> DataFrame:
    """Score, violations and failed rules of the latest score row."""
    latest = F.max(
        F.struct("recorded_at", "batch_id", "checkpoint", "dq_score", "total_violations", "rules_failed")
    )
    return scores.agg(latest.alias("s")).select(
        "s.batch_id", "s.checkpoint", "s.dq_score", "s.total_violations", "s.rules_failed"
    )
