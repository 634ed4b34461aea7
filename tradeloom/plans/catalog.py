"""Every query of the package by name: (spark, folder of tables) -> DataFrame."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import RULES, TRADES_CSV_SCHEMA
from tradeloom.functions.ordering import number_rows
from tradeloom.functions.staging import at_once, free, scratch_path, settle, shuffles_dropped, tracked
from tradeloom.operators import clean, deadletter, enrich, exposure, lineage, quality, star
from tradeloom.plans import observability, pipeline
from tradeloom.plans.facts import FactStore
from tradeloom.sources import files
from tradeloom.sources.lineage_log import lineage_log, node_name
from tradeloom.sources.trades import raw_trades, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONFIG = {"dedup": {"tie_break": ["src_suppkey", "src_partkey"]}}
BATCH = "b_test"
PIPELINE = "trades"
PARTS_RULE = {
    "name": "part_listed", "type": "referential_integrity", "mode": "table",
    "field": "src_partkey", "lookup_table": "part", "lookup_field": "p_partkey",
    "severity": "ERROR", "stage": "post_ingest",
}
CROSS_RULES = [
    {"name": "settles_after_trade", "type": "cross_field", "fields": ["trade_date", "settlement_date"],
     "expr_alias": "settlement_after_trade", "stage": "pre_load"},
    {"name": "settles_soon", "type": "cross_field",
     "fields": ["trade_date", "settlement_date", "days_to_settlement"],
     "expr": "days_to_settlement BETWEEN 0 AND 3", "severity": "ERROR", "stage": "pre_load"},
    {"name": "large_trade_has_entity", "type": "cross_field", "fields": ["direction", "lei_code"],
     "expr": "NOT (notional_usd > 60000 AND (lei_code IS NULL OR lei_code = ''))", "stage": "pre_load"},
    {"name": "absent_field", "type": "cross_field", "fields": ["book"], "expr": "book = 'A'",
     "stage": "pre_load"},
]
STALE_RULES = [
    {"name": "supplier_is_fresh", "type": "freshness", "field": "trade_date", "source": "src_suppkey",
     "as_of": "1998-12-01", "max_age_days": 14, "severity": "ERROR", "stage": "post_ingest"},
    {"name": "exchange_is_fresh", "type": "freshness", "field": "trade_date", "source": "exchange",
     "as_of": "1998-12-01 12:00:00", "severity": "WARN", "stage": "post_ingest"},
    {"name": "absent_source", "type": "freshness", "field": "trade_date", "source": "book", "stage": "post_ingest"},
    {"name": "product_present", "type": "null_check", "field": "product_id", "stage": "post_ingest"},
]
#: Feed columns in the order of the CSV, and a feed whose quantity is read as a number at once.
FEED_COLUMNS = [c.split()[0] for c in TRADES_CSV_SCHEMA.split(", ")]
TYPED_FEED = TRADES_CSV_SCHEMA.replace("quantity string", "quantity double")
NODE = "fact_trades.s7"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared frames -----------------------------------------------------------

def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return settle(pipeline.clean_stage(raw_trades(spark, folder), CONFIG), "cleaned")


def _attributes(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.attribute_stage(_cleaned(spark, folder))


def _dims(trades: DataFrame, *more: Callable) -> list[DataFrame]:
    """Product, counterparty and date dimensions as stored tables, and further jobs."""
    return at_once(
        lambda: settle(star.dim_product(trades), "dim_product"),
        lambda: settle(star.dim_counterparty(trades), "dim_counterparty"),
        lambda: settle(star.dim_date(trades), "dim_date"),
        *more,
    )


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched trades as a written table; what was written and shuffled on the way is deleted."""
    with shuffles_dropped(spark):
        with tracked() as made:
            rows = pipeline.enrich_stage(_cleaned(spark, folder))
        rows = settle(rows, "enriched")
    free(spark, made)
    return rows


def _facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    rows = _enriched(spark, folder)
    valid, _ = star.split_by_constraints(rows)
    products, counterparties, dates, keys = _dims(rows, lambda: star.trade_keys(valid))
    facts = star.fact_trades(valid, keys, products, counterparties, BATCH, PIPELINE)
    return facts, products, counterparties, dates


VIEW_COLUMNS = [
    "trade_id", "trade_date_key", "product_key", "counterparty_key", "status_key", "currency", "notional_usd",
    "notional_eur", "net_notional_usd", "days_to_settlement",
]


def _view_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What the views need of the facts: no running totals and no row numbers are computed."""
    rows = exposure.position_net_rows(_attributes(spark, folder))
    products, counterparties, dates, valid = _dims(rows, lambda: star.split_by_constraints(rows)[0])
    facts = star.resolve_keys(valid, products, counterparties).select(*VIEW_COLUMNS, F.lit(BATCH).alias("batch_id"))
    return facts, products, counterparties, dates


def _stored_runs(spark: SparkSession, folder: str, **more) -> pipeline.Tables:
    """The tables that two runs of the pipeline wrote: all trades, then those of every other supplier."""
    tables = pipeline.Tables(scratch_path(spark, "runs"))
    rows = raw_trades(spark, folder)
    for batch, part in (("b_1", rows), ("b_2", rows.where("src_suppkey % 2 = 0"))):
        pipeline.run_pipeline(part, tables.root, batch, PIPELINE, config=CONFIG | more)
    return tables


def _month_batch() -> Column:
    return F.concat(F.lit("b_"), F.date_format("trade_date", "yyyyMM"))


def _with_batch(df: DataFrame) -> DataFrame:
    return df.withColumn("batch_id", _month_batch())


def _batch_time(hours: Column) -> Column:
    start = F.to_timestamp_ntz(F.concat(F.substring("batch_id", 3, 6), F.lit("01")), F.lit("yyyyMMdd"))
    return start + F.make_dt_interval(hours=hours)


# --- sources and sinks -------------------------------------------------------

@query
def scan_parquet(spark, folder):
    return files.read_feed(spark, f"{folder}/orders.parquet")


@query
def scan_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "feed") + ".csv"
    files.write_csv(raw_trades(spark, folder).drop("src_suppkey", "src_partkey"), path)
    return files.read_feed(spark, path, TYPED_FEED)


@query
def scan_latest_file(spark, folder):
    inbox = scratch_path(spark, "inbox")
    feed = raw_trades(spark, folder).drop("src_suppkey", "src_partkey")
    settled = F.col("settlement_status") == "SETTLED"
    files.write_csv(feed.where(settled), f"{inbox}/trades_20260519.csv")
    files.write_csv(feed.where(~settled), f"{inbox}/trades_20260520.csv")
    return files.read_feed(spark, files.newest_feed(spark, inbox), TYPED_FEED)


def _faulty_feed(spark: SparkSession, folder: str) -> str:
    """Path of a CSV feed with unreadable quantities, lines cut short and lines with a field too many."""
    part = F.col("src_partkey")
    rows = raw_trades(spark, folder).withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("trade_date", "settlement_date")}
    )
    quantity = F.when(part % 17 == 0, F.lit("abc")).otherwise(F.col("quantity").cast("string"))
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FEED_COLUMNS]
    line = F.concat_ws(",", *texts)
    short = F.concat_ws(",", *texts[:-2])
    line = F.when(part % 11 == 0, short).when(part % 13 == 0, F.concat(line, F.lit(",late"))).otherwise(line)
    path = scratch_path(spark, "faulty") + ".csv"
    # one column named like the header line, so that every file has the header
    lines = rows.withColumn("quantity", quantity).select(line.alias(",".join(FEED_COLUMNS)))
    lines.write.options(header=True, sep="\u0001", quote="\u0002").csv(path)
    return path


@query
def csv_bad_records(spark, folder):
    """Lines that the reader or the casts cannot take, as dead letters, and the rows that went on."""
    root = scratch_path(spark, "warehouse")
    feed = files.read_feed(spark, _faulty_feed(spark, folder), TRADES_CSV_SCHEMA, keep_malformed=True)
    pipeline.run_pipeline(feed, root, BATCH, PIPELINE, stages=["ingest", "clean"])
    tables = pipeline.Tables(root)
    schema = spark.createDataFrame([], f"{TRADES_CSV_SCHEMA}, raw_line string").schema
    dead = deadletter.read(spark, tables.path("dead_letters"), BATCH, schema)
    return dead.where("_dlq_stage <> 'Dedup'").select(
        "raw_line", "trade_id", "notional", "quantity", F.col("_dlq_stage").alias("stage"), F.col("_dlq_reason").alias("reason")
    )


@query
def csv_good_records(spark, folder):
    """What the clean stage has of the same feed: readable amounts only."""
    feed = settle(files.read_feed(spark, _faulty_feed(spark, folder), TRADES_CSV_SCHEMA, keep_malformed=True))
    return pipeline.typed_stage(files.split_malformed(feed)[0])[0].select("trade_id", "notional", "quantity")


@query
def metadata_roundtrip(spark, folder):
    """The stored stage runs of two batches, without times."""
    runs = _stored_runs(spark, folder).read(spark, "pipeline_runs")
    return runs.drop("started_at", "duration_sec", "note")


@query
def lineage_json_roundtrip(spark, folder):
    path = scratch_path(spark, "graph")
    lineage.write_json(lineage_log(spark, folder), path)
    return lineage.read_json(spark, path)


# --- cleaning ----------------------------------------------------------------

@query
def null_fill(spark, folder):
    return clean.null_fill(raw_trades(spark, folder))


@query
def null_fill_counts(spark, folder):
    return clean.null_fill_counts(raw_trades(spark, folder))


@query
def row_hash(spark, folder):
    hashed = clean.row_hash(raw_trades(spark, folder))
    return hashed.select("trade_id", "src_suppkey", "src_partkey", "row_hash")


@query
def type_cast_clean(spark, folder):
    return clean.type_cast(clean.null_fill(raw_trades(spark, folder)))[0]


@query
def type_cast_rejects(spark, folder):
    rejects = clean.type_cast(clean.null_fill(raw_trades(spark, folder)))[1]
    return rejects.withColumnRenamed("_failed_columns", "failed_columns")


@query
def dedup(spark, folder):
    return pipeline.clean_stage(raw_trades(spark, folder), CONFIG)


@query
def dedup_rejects(spark, folder):
    typed, _ = pipeline.typed_stage(raw_trades(spark, folder))
    return clean.dedup_split(typed, **pipeline.dedup_options(CONFIG))[1]


@query
def duplicate_trade_ids(spark, folder):
    """Rows whose trade id occurs more than once."""
    rows = raw_trades(spark, folder)
    repeated = rows.groupBy("trade_id").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(repeated.select("trade_id"), "trade_id", "left_semi").select(
        "trade_id", "trade_date", "src_suppkey", "src_partkey"
    )


@query
def batch_counts(spark, folder):
    """Raw, clean and duplicate rows; rows without an id are left out of clean."""
    per_id = raw_trades(spark, folder).groupBy("trade_id").agg(F.count("*").alias("n"))
    counts = per_id.agg(
        F.sum("n").alias("raw_count"),
        F.count_if(F.col("trade_id").isNotNull()).alias("clean_count"),
    )
    return counts.withColumn("duplicate_count", F.col("raw_count") - F.col("clean_count"))


# --- enrichment --------------------------------------------------------------

@query
def fx_convert(spark, folder):
    rows = enrich.fx_convert(pipeline.clean_stage(raw_trades(spark, folder), CONFIG))
    return rows.select("trade_id", "currency", "notional", "fx_rate_to_usd", "notional_usd", "notional_eur")


@query
def date_expand(spark, folder):
    rows = enrich.date_expand(raw_trades(spark, folder))
    return rows.select(
        "trade_id", "src_suppkey", "src_partkey", "trade_year", "trade_quarter", "trade_month",
        "trade_day_of_week", "is_month_end", "is_trading_day", "days_to_settlement",
    )


@query
def lei_lookup(spark, folder):
    rows = enrich.lei_lookup(raw_trades(spark, folder))
    return rows.select("trade_id", "src_suppkey", "src_partkey", "counterparty_id", *enrich.LEGAL_ENTITY_COLUMNS)


@query
def exposure_rollup(spark, folder):
    return exposure.exposure_rollup(_attributes(spark, folder)).select(
        "trade_id", "counterparty_id", "asset_class", "trade_date", "notional_usd",
        "cpty_total_notional_usd", "cpty_trade_count", "running_notional_usd",
        "asset_class_exposure_usd",
    )


@query
def running_exposure(spark, folder):
    return exposure.running_exposure(_attributes(spark, folder)).select(
        "trade_id", "counterparty_id", "trade_date", "notional_usd", "running_notional_usd"
    )


@query
def position_net(spark, folder):
    rows = enrich.fx_convert(pipeline.clean_stage(raw_trades(spark, folder), CONFIG))
    return exposure.position_net(rows)


@query
def position_net_rows(spark, folder):
    return exposure.position_net_rows(_attributes(spark, folder)).select(
        "trade_id", "counterparty_id", "product_id", "buy_notional_usd", "sell_notional_usd",
        "net_notional_usd",
    )


# --- star schema -------------------------------------------------------------

@query
def surrogate_keys(spark, folder):
    rows = pipeline.clean_stage(raw_trades(spark, folder), CONFIG)
    return number_rows(rows.select("trade_id"), ["trade_id"], "trade_key")


@query
def dim_product(spark, folder):
    return star.dim_product(_attributes(spark, folder))


@query
def dim_counterparty(spark, folder):
    return star.dim_counterparty(_attributes(spark, folder))


@query
def dim_date(spark, folder):
    return star.dim_date(raw_trades(spark, folder))


@query
def dim_product_new(spark, folder):
    rows = _attributes(spark, folder)
    existing = settle(star.dim_product(rows.where("product_id <= 'PROD005'")))
    return star.dim_product(rows, existing).select("product_key", "product_id", "asset_class", "currency", "exchange")


@query
def dim_counterparty_new(spark, folder):
    rows = _attributes(spark, folder)
    existing = settle(star.dim_counterparty(rows.where("counterparty_id <= 'CP003'")))
    return star.dim_counterparty(rows, existing).select(
        "counterparty_key", "counterparty_id", "legal_entity_name", "lei_code", "lei_country", "credit_rating"
    )


@query
def fact_key_resolution(spark, folder):
    rows = _attributes(spark, folder)
    products, counterparties, _ = _dims(rows)
    return star.resolve_keys(rows, products, counterparties).select(
        "trade_id", "product_key", "counterparty_key", "status_key", "trade_date_key", "settlement_date_key"
    )


@query
def fact_constraint_rejects(spark, folder):
    rejects = star.split_by_constraints(_attributes(spark, folder))[1]
    return rejects.select("trade_id", "direction", "constraint_reason")


def _gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Trades as a source without defaults gives them: ids, amounts, quantities and dates are missing at times."""
    rows = clean.cast_columns(raw_trades(spark, folder))
    gaps = {"trade_id": 31, "notional": 37, "quantity": 41, "trade_date": 43, "direction": 47}
    part = F.col("src_partkey")
    return rows.withColumns({c: F.when(part % n != 0, F.col(c)) for c, n in gaps.items()})


@query
def fact_null_rejects(spark, folder):
    """Trades with missing values that the load would reject, with the first reason."""
    rejects = star.split_by_constraints(_gappy(spark, folder))[1]
    return rejects.select("trade_id", "src_suppkey", "src_partkey", "notional", "quantity", "constraint_reason")


@query
def dedup_null_keys(spark, folder):
    """The newest trade of each product, those without a product being one group and those without a date last."""
    rows = _gappy(spark, folder).select("product_id", "trade_date", "trade_id", "src_suppkey", "src_partkey")
    return clean.dedup(rows, ["product_id"], "trade_date", tie_break=["trade_id", "src_suppkey", "src_partkey"])


@query
def fact_unique_rejects(spark, folder):
    """Typed trades, duplicates included, that the load would reject."""
    typed, _ = pipeline.typed_stage(raw_trades(spark, folder))
    rejects = star.split_by_constraints(typed)[1]
    return rejects.select("trade_id", "src_suppkey", "src_partkey", "constraint_reason")


@query
def fact_trades(spark, folder):
    return _facts(spark, folder)[0]


@query
def fact_upsert(spark, folder):
    """All facts, then a second load of the trades from 1998 on."""
    rows = _enriched(spark, folder)
    with shuffles_dropped(spark):
        valid, _ = star.split_by_constraints(rows)
        products, counterparties, _, keys = _dims(rows, lambda: star.trade_keys(valid))
        first = settle(star.fact_trades(valid, keys, products, counterparties, "b_1", PIPELINE), "facts")
        again = valid.where("trade_year >= 1998")
        keys = star.trade_keys(again, first.agg(F.max("trade_key")).first()[0])
    second = star.fact_trades(again, keys, products, counterparties, "b_2", PIPELINE)
    return star.upsert_facts(first, second)


@query
def fact_current_after_compaction(spark, folder):
    """All facts, two loads that replace some of them, and a compaction of the buckets they touch."""
    rows = _enriched(spark, folder)
    valid, _ = star.split_by_constraints(rows)
    products, counterparties, _ = _dims(rows)
    store = FactStore(spark, pipeline.Tables(scratch_path(spark, "facts")))
    for batch, part in (
        ("b_1", valid), ("b_2", valid.where("trade_year >= 1998")), ("b_3", valid.where("product_id <= 'PROD003'")),
    ):
        load_id, start = store.next_load(), store.last_key()
        staged = star.fact_trades(store.spread(part), star.trade_keys(part, start), products, counterparties, batch, PIPELINE)
        store.replace(part, load_id)
        store.commit(load_id, batch, max(start, store.append(staged, load_id)))
    store.compact()
    return store.current().select("trade_id", "trade_key", "batch_id", "product_key", "notional_usd", "running_notional_usd")


@query
def vw_daily_cpty_exposure(spark, folder):
    facts, _, counterparties, dates = _view_facts(spark, folder)
    return star.daily_counterparty_exposure(facts, dates, counterparties)


@query
def vw_asset_class_exposure(spark, folder):
    facts, products, _, dates = _view_facts(spark, folder)
    return star.asset_class_exposure(facts, dates, products)


@query
def class_counterparties_sketch(spark, folder):
    """Counterparties per asset class in two periods, from sketches stored per day and class."""
    facts, products, _, _ = _view_facts(spark, folder)
    stored = settle(star.distinct_sketches(facts, products), "sketches")
    year = F.floor(F.col("trade_date_key") / 10000).cast("int").alias("year")
    by_year = star.distinct_of_period(stored.withColumn("year", year), 19930101, 19961231, "year")
    whole = star.distinct_of_period(stored, 19930215, 19971110).withColumn("year", F.lit(None).cast("int"))
    return by_year.unionByName(whole)


@query
def vw_settlement_failures(spark, folder):
    facts, products, counterparties, _ = _view_facts(spark, folder)
    return star.settlement_failures(facts, counterparties, products)


# --- data quality ------------------------------------------------------------

def _violations(df: DataFrame, rules: list) -> DataFrame:
    return quality.violations(df, rules, BATCH).drop("ts")


@query
def dq_null_check(spark, folder):
    rules = [r for r in quality.rules_for("post_ingest") if r["type"] == "null_check"]
    return _violations(raw_trades(spark, folder), rules)


@query
def dq_range_check(spark, folder):
    rules = [r for r in RULES if r["type"] == "range_check"]
    return _violations(_attributes(spark, folder), rules)


@query
def dq_ref_static(spark, folder):
    rules = [r for r in quality.rules_for("post_ingest") if r["type"] == "referential_integrity"]
    return _violations(raw_trades(spark, folder), rules)


@query
def dq_ref_table(spark, folder):
    listed = table(spark, folder, "part").where("p_size <= 25")
    return quality.violations(
        raw_trades(spark, folder), [PARTS_RULE], BATCH, tables={"part": listed}
    ).drop("ts")


@query
def dq_cross_field(spark, folder):
    return _violations(_attributes(spark, folder), CROSS_RULES)


@query
def dq_violations(spark, folder):
    return _violations(raw_trades(spark, folder), quality.rules_for("post_ingest"))


@query
def dq_violations_first(spark, folder):
    return quality.first_violations(dq_violations(spark, folder), 1000)


@query
def dq_rule_counts(spark, folder):
    return quality.rule_counts(_attributes(spark, folder), RULES)


@query
def dq_checkpoint_score(spark, folder):
    raw, cleaned = raw_trades(spark, folder), _cleaned(spark, folder)
    frames = {
        "post_ingest": raw, "post_clean": cleaned, "pre_load": pipeline.attribute_stage(cleaned),
    }
    scores = [quality.run_checkpoint(df, checkpoint) for checkpoint, df in frames.items()]
    return scores[0].unionByName(scores[1]).unionByName(scores[2])


@query
def dq_run_all(spark, folder):
    return quality.run_all(_attributes(spark, folder))


def dq_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The scores that two runs of the pipeline stored."""
    return _stored_runs(spark, folder).read(spark, "dq_scores").drop("duration_sec")


@query
def dq_stored_violations(spark, folder):
    """Stored violations of two batches, counted per checkpoint and rule."""
    found = _stored_runs(spark, folder).read(spark, "dq_violations")
    counts = found.groupBy("batch_id", "stage", "rule_name").agg(F.count(F.lit(1)).alias("violations"))
    return counts.withColumnRenamed("stage", "checkpoint")


@query
def dq_freshness(spark, folder):
    """Sources whose newest trade is too old, next to a rule on rows."""
    return _violations(raw_trades(spark, folder), STALE_RULES)


@query
def dq_freshness_score(spark, folder):
    """The score of that checkpoint as its write counted it."""
    evaluation = quality.evaluate(raw_trades(spark, folder), STALE_RULES, BATCH)
    evaluation.violations.write.parquet(scratch_path(spark, "violations"))
    return quality.checkpoint_scores(evaluation.counts(spark))


ROUTE_RULES = [*quality.rules_for("post_clean"), *quality.rules_for("pre_load"), *CROSS_RULES]


@query
def dq_route(spark, folder):
    """Every trade with its route, written once in folders by route; the worse routes are dead."""
    kept, dead, _ = quality.settle_routed(_attributes(spark, folder), ROUTE_RULES, ["CRITICAL", "ERROR"])
    sides = [rows.select("trade_id", "dq_route", "dq_rules", F.lit(side).alias("side")) for rows, side in ((kept, "kept"), (dead, "dead"))]
    return sides[0].unionByName(sides[1])


@query
def dlq_quality(spark, folder):
    """Dead letters of a run that buries rows breaking an ERROR rule after cleaning."""
    root = scratch_path(spark, "warehouse")
    config = CONFIG | {"dead_letter_severities": {"clean": ["CRITICAL", "ERROR"]}}
    pipeline.run_pipeline(raw_trades(spark, folder), root, BATCH, PIPELINE, stages=["clean"], config=config)
    dead = deadletter.read(spark, pipeline.Tables(root).path("dead_letters"), BATCH)
    return dead.where("_dlq_stage = 'clean'").select("trade_id", "notional", "settlement_status", F.col("_dlq_reason").alias("reason"))


@query
def dq_rule_errors(spark, folder):
    """Rules that cannot run report themselves once and leave the others alone."""
    base = {"type": "range_check", "stage": "post_ingest", "severity": "WARN"}
    rules = [
        {**base, "name": "no_field"}, {**base, "name": "bad_bound", "field": "quantity", "min": "abc"},
        {"name": "product_present", "type": "null_check", "field": "product_id", "stage": "post_ingest"},
    ]
    found = _violations(raw_trades(spark, folder), rules)
    return found.groupBy("rule_name", "severity", "field_name").agg(F.count(F.lit(1)).alias("violations"))


def _stored_violations(spark: SparkSession, folder: str) -> DataFrame:
    return quality.violations(
        raw_trades(spark, folder), quality.rules_for("post_ingest"), _month_batch(),
        ts=F.col("trade_date"),
    )


@query
def violations_filtered(spark, folder):
    return quality.query_violations(_stored_violations(spark, folder), severity="error", limit=500)


@query
def violations_csv_roundtrip(spark, folder):
    """Violations stored by day, those of two years exported in order and read back."""
    stored, path = scratch_path(spark, "violations"), scratch_path(spark, "export")
    found = quality.dated(_stored_violations(spark, folder), F.trunc("ts", "month"))
    found.write.partitionBy("run_date").parquet(stored)
    quality.export_csv(spark.read.parquet(stored), path, "1994-01-01", "1995-12-31")
    columns = "run_date date, batch_id string, rule_name string, severity string, field_name string, offending_value string, row_key string, stage string, ts timestamp_ntz"
    return spark.read.schema(columns).csv(path, header=True)


@query
def violation_summary(spark, folder):
    return quality.violation_summary(_stored_violations(spark, folder))


@query
def latest_scores(spark, folder):
    return quality.latest_scores(dq_scores(spark, folder), 20).drop("recorded_at")


@query
def vw_dq_score_trend(spark, folder):
    return quality.score_trend(dq_scores(spark, folder)).drop("recorded_at")


@query
def dq_scorecard(spark, folder):
    return quality.scorecard(dq_scores(spark, folder))


# --- dead letters ------------------------------------------------------------

def _dead_letters(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Cast failures and duplicates."""
    typed, failed = pipeline.typed_stage(raw_trades(spark, folder))
    duplicates = clean.dedup_split(typed, **pipeline.dedup_options(CONFIG))[1]
    return failed.drop("_failed_columns"), duplicates


@query
def dlq_roundtrip(spark, folder):
    path = scratch_path(spark, "dead")
    failed, duplicates = _dead_letters(spark, folder)
    deadletter.write(failed, path, "type_cast_failure", BATCH, "TypeCast")
    deadletter.write(duplicates, path, "duplicate_trade_id", BATCH, "Dedup")
    return deadletter.read(spark, path, BATCH, failed.schema).drop("_dlq_ts")


@query
def dlq_counts(spark, folder):
    failed, duplicates = _dead_letters(spark, folder)
    tagged = [
        deadletter.tag(failed, "type_cast_failure", _month_batch(), "TypeCast"),
        deadletter.tag(duplicates, "duplicate_trade_id", _month_batch(), "Dedup"),
    ]
    columns = deadletter.PARTITIONS
    return deadletter.count_by_batch(tagged[0].select(*columns).unionByName(tagged[1].select(*columns)))


@query
def dlq_reprocess(spark, folder):
    """Cast failures repaired by dropping the unreadable amount, then cleaned again."""
    failed, _ = _dead_letters(spark, folder)
    dead = deadletter.tag(failed, "type_cast_failure", BATCH, "TypeCast")

    def fix(rows: DataFrame) -> DataFrame:
        readable = F.col("notional").try_cast("double").isNotNull()
        return clean.type_cast(clean.null_fill(rows.withColumn("notional", F.when(readable, F.col("notional")))))[0]

    return deadletter.reprocess(dead, fix)


@query
def dlq_batch_failure(spark, folder):
    """A step that fails sends its whole input to the dead letters."""
    path = scratch_path(spark, "dead")
    rows = raw_trades(spark, folder)

    def step(df: DataFrame) -> DataFrame:
        raise ValueError("no rates for this batch")

    try:
        deadletter.run_or_bury(rows, step, lambda df: None, path, BATCH, "FxConvert")
    except ValueError:
        pass
    return deadletter.read(spark, path, BATCH, rows.schema).drop("_dlq_ts")


@query
def dlq_route_keys(spark, folder):
    """Trades split by a table of failed keys; counts of both sides."""
    rows = raw_trades(spark, folder)
    keys = clean.type_cast(clean.null_fill(rows))[1].select("trade_id")
    kept, dead = deadletter.route_keys(rows, keys, "trade_id")
    sides = kept.select(F.lit("kept").alias("side")).unionByName(dead.select(F.lit("dead").alias("side")))
    return sides.groupBy("side").agg(F.count("*").alias("records"))


# --- run metadata ------------------------------------------------------------

@query
def stage_counts(spark, folder):
    """Records in, out and dead per trade month and stage."""
    raw = settle(raw_trades(spark, folder), "raw")
    typed, failed = pipeline.typed_stage(raw)
    cleaned, duplicates, *_ = clean.dedup_settled(typed, **pipeline.dedup_options(CONFIG))
    valid, rejects = star.split_by_constraints(cleaned)
    raw, failed, cleaned, duplicates, rejects = (
        _with_batch(df).select("batch_id") for df in (raw, failed, cleaned, duplicates, rejects)
    )
    return observability.stage_counts(
        {
            "ingest": {"in": [raw], "out": [raw]},
            "clean": {"in": [raw], "out": [cleaned], "dead": [failed, duplicates]},
            "enrich": {"in": [cleaned], "out": [cleaned]},
            "load": {"in": [cleaned], "out": [cleaned], "dead": [rejects]},
        },
        by=["batch_id"],
    )


@query
def latest_runs(spark, folder):
    runs = _stored_runs(spark, folder).read(spark, "pipeline_runs")
    return observability.latest_runs(runs, 4).drop("started_at", "duration_sec", "note")


# --- lineage -----------------------------------------------------------------

@query
def lineage_emitted(spark, folder):
    """Edges every trade month's batch emits; fills only where there were nulls."""
    counts = clean.null_fill_counts(_with_batch(raw_trades(spark, folder)), by=["batch_id"])
    when = _batch_time(F.lit(1))
    return observability.emitted_edges(counts, when)


@query
def lineage_batch_edges(spark, folder):
    return lineage.for_batch(lineage_log(spark, folder), "b_3").orderBy("ts")


@query
def lineage_latest_batch(spark, folder):
    """The stored edges of the latest of two runs."""
    tables = _stored_runs(spark, folder)
    return lineage.of_latest_run(tables.read(spark, "lineage_edges"), tables.read(spark, "pipeline_runs")).drop("ts")


@query
def lineage_kept_graph(spark, folder):
    """The collapsed graph that two runs kept, without collapsing their edges again."""
    tables = _stored_runs(spark, folder, keep_lineage_graph=True)
    return lineage.GraphStore(spark, tables.path("lineage_graph")).edges()


@query
def violations_latest_batch(spark, folder):
    """The stored violations of the latest of two runs, counted per checkpoint and rule."""
    tables = _stored_runs(spark, folder)
    found = lineage.of_latest_run(tables.read(spark, "dq_violations"), tables.read(spark, "pipeline_runs"))
    counts = found.groupBy("batch_id", "stage", "rule_name").agg(F.count(F.lit(1)).alias("violations"))
    return counts.withColumnRenamed("stage", "checkpoint")


@query
def lineage_edge_count(spark, folder):
    return lineage_log(spark, folder).agg(F.count("*").alias("edge_count"))


@query
def lineage_merge(spark, folder):
    log = lineage_log(spark, folder)
    return lineage.merge(lineage.for_batch(log, "b_1"), lineage.for_batch(log, "b_2"))


@query
def lineage_graph_edges(spark, folder):
    return lineage.collapse(lineage_log(spark, folder))


@query
def lineage_graph_incremental(spark, folder):
    """The collapsed graph after three groups of batches were folded in, the newest first."""
    log = lineage_log(spark, folder)
    store = lineage.GraphStore(spark, scratch_path(spark, "graph"))
    number = F.substring("batch_id", 3, 9).cast("int")
    for part in (number >= 5, number == 0, number.between(1, 4)):
        store.fold(log.where(part))
    return store.edges()


@query
def lineage_ancestors(spark, folder):
    return lineage.ancestors(lineage_log(spark, folder), NODE)


@query
def lineage_descendants(spark, folder):
    return lineage.descendants(lineage_log(spark, folder), node_name(2))


@query
def lineage_path(spark, folder):
    return lineage.shortest_path(lineage_log(spark, folder), node_name(1), NODE)


@query
def lineage_transforms_touching(spark, folder):
    return lineage.transforms_touching(lineage_log(spark, folder), node_name(90))


@query
def lineage_impact(spark, folder):
    return lineage.impact(lineage.collapse(lineage_log(spark, folder)), node_name(90))


@query
def lineage_direct(spark, folder):
    return lineage.direct(lineage.collapse(lineage_log(spark, folder)), node_name(90))


@query
def lineage_layers(spark, folder):
    return lineage.nodes_by_layer(lineage_log(spark, folder))


@query
def lineage_summary(spark, folder):
    return lineage.summary(lineage_log(spark, folder))


@query
def lineage_summary_members(spark, folder):
    return lineage.summary_members(lineage_log(spark, folder))


@query
def lineage_nodes(spark, folder):
    return lineage.export_nodes(lineage_log(spark, folder))


@query
def lineage_edges_export(spark, folder):
    return lineage.export_edges(lineage_log(spark, folder))


@query
def lineage_cytoscape_nodes(spark, folder):
    return lineage.cytoscape_nodes(lineage_log(spark, folder))


@query
def lineage_cytoscape_edges(spark, folder):
    return lineage.cytoscape_edges(lineage_log(spark, folder))


@query
def rdf_triples(spark, folder):
    return lineage.triples(lineage_log(spark, folder))


# --- the whole pipeline ------------------------------------------------------

@query
def pipeline_end_to_end(spark, folder):
    """Run and store every stage, then query the stored star schema."""
    root = scratch_path(spark, "warehouse")
    pipeline.run_pipeline(raw_trades(spark, folder), root, BATCH, PIPELINE, config=CONFIG)
    tables = pipeline.Tables(root)
    return star.daily_counterparty_exposure(
        pipeline.current_facts(spark, tables),
        tables.read(spark, "dim_date"),
        tables.read(spark, "dim_counterparty"),
    )
