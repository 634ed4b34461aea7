"""The trade pipeline: ingest, clean, enrich, load, with quality checkpoints.

Every stage writes a table once and the next stage starts from it. Record counts,
rule counts and null counts are gathered by the jobs that write (their last stage, so
a lost executor or a repeated task cannot change them); nothing is read again to be
counted.
"""

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import RULES
from tradeloom.functions.staging import at_once, exists, free, settle, settle_counted, shuffles_dropped, tracked
from tradeloom.operators import clean, deadletter, enrich, exposure, lineage, quality, star
from tradeloom.plans import observability, registry
from tradeloom.plans.facts import BUCKETS, FactStore
from tradeloom.sources import files

STAGES = ("ingest", "clean", "enrich", "load")
#: Stages whose rows are written anew, so that those they came from are not read again.
SETTLING = ("clean", "enrich")
CHECKPOINTS = {"ingest": "post_ingest", "clean": "post_clean", "enrich": "pre_load"}
PIPELINE_NAME = "daily_trade_pipeline"


# --- stages as DataFrame functions -------------------------------------------

def typed_stage(raw: DataFrame, config: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """(filled and cast rows, rows that failed a cast)."""
    config = config or {}
    filled = clean.null_fill(raw, config.get("null_fill"))
    return clean.type_cast(filled, config.get("type_cast"))


def dedup_options(config: Mapping | None) -> dict:
    options = (config or {}).get("dedup", {})
    return {
        "keys": options.get("key_cols", ["trade_id"]),
        "order_col": options.get("order_col", "trade_date"),
        "ascending": options.get("order_asc", False),
        "tie_break": options.get("tie_break", ()),
    }


def clean_stage(raw: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Filled and cast rows without duplicates."""
    return clean.dedup(typed_stage(raw, config)[0], **dedup_options(config))


def priced(rows: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Currency conversion."""
    fx = (config or {}).get("fx_convert", {})
    return enrich.fx_convert(
        rows, fx.get("source_col", "notional"), fx.get("currency_col", "currency"), fx.get("rates_override")
    )


def described(rows: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Calendar and legal entities."""
    config = config or {}
    dates, lei = (config.get(k, {}) for k in ("date_expand", "lei_lookup"))
    reference = None
    if lei.get("lookup_path"):
        key = lei.get("reference_key", "counterparty_id")
        reference = rows.sparkSession.read.csv(lei["lookup_path"], header=True)
        missing = clean.missing_columns(reference, [key, *enrich.LEGAL_ENTITY_COLUMNS])
        if missing:
            raise ValueError(f"{lei['lookup_path']} lacks {missing}")
        reference = reference.select(key, *enrich.LEGAL_ENTITY_COLUMNS)
    return rows.transform(
        enrich.date_expand,
        dates.get("date_col", "trade_date"),
        dates.get("settle_col", "settlement_date"),
    ).transform(
        enrich.lei_lookup,
        lei.get("counterparty_col", "counterparty_id"),
        reference,
        lei.get("reference_key", "counterparty_id"),
    )


def attribute_stage(cleaned: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Row-wise enrichment: currency conversion, calendar, legal entities."""
    return described(priced(cleaned, config), config)


def enrich_stage(cleaned: DataFrame, config: Mapping | None = None) -> DataFrame:
    """All enrichment; group totals come from one summary of the cleaned trades, which are shuffled as they are."""
    return exposure.exposures(cleaned, lambda rows: priced(rows, config), lambda rows: described(rows, config))


# --- the written pipeline ----------------------------------------------------

@dataclass
class Tables:
    """Where a run keeps its tables."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        """A stored table, or None if it was never written."""
        if not exists(spark, self.path(name)):
            return None
        try:
            return spark.read.parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
                return None
            raise

    def append(self, df: DataFrame, name: str, partition: Sequence[str] = ("batch_id",)) -> None:
        df.write.mode("append").partitionBy(*partition).parquet(self.path(name))


@dataclass
class Run:
    """Identity and stage results of one pipeline run."""

    batch_id: str
    pipeline_name: str
    started_at: datetime
    results: list[tuple] = field(default_factory=list)
    scores: dict[str, float] = field(default_factory=dict)

    def record(self, stage, status, counts, seconds, note=None) -> None:
        """Keep a stage's result; the last count is the dead rows of the run so far."""
        before = self.results[-1][8] if self.results else 0
        self.results.append(
            (self.batch_id, self.pipeline_name, self.started_at, stage, status,
             *counts, before + counts[2], seconds, note)
        )


def new_batch_id(now: datetime | None = None) -> str:
    return f"b_{(now or datetime.now(timezone.utc)):%Y%m%d_%H%M%S}"


def run_pipeline(
    raw: DataFrame,
    root: str,
    batch_id: str | None = None,
    pipeline_name: str = PIPELINE_NAME,
    stages: Sequence[str] = STAGES,
    config: Mapping | None = None,
    rules: Sequence[Mapping] = RULES,
) -> Run:
    """Run the chosen stages in order and append everything to the tables at ``root``.

    The rows of ``raw`` are written once; every stage and count reads written rows.
    A stage that fails sends its whole input, as last written, to the dead letters,
    is recorded as FAILED and ends the run with RuntimeError. Run metadata is written
    either way, also if the input itself cannot be read or buried.

    ``config`` may hold, besides the options of the steps: ``checkpoints`` (stage to
    checkpoint name), ``extra_steps`` (stage to names of registered steps that follow
    its own), ``required_columns`` (stage to columns; a missing one is noted), ``fact_buckets``
    (number of buckets of a store without facts), ``keep_lineage_graph`` (fold the run's
    edges into the collapsed graph of all runs), and
    ``dead_letter_severities`` (stage to severities: rows that break a rule of its
    checkpoint that severely go to the dead letters).

    Rows of ``files.read_feed(..., keep_malformed=True)`` are sorted out first: malformed
    lines go to the dead letters with their raw text and file.

    Shuffle files are deleted with the job that wrote them, the rows that a stage started from
    once the next stage's are written, and all other scratch tables when the run ends.
    """
    spark = raw.sparkSession
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    run = Run(batch_id or new_batch_id(), pipeline_name, now)
    with shuffles_dropped(spark), tracked() as made:
        try:
            _run_stages(raw, Tables(root), run, stages, config or {}, rules, made)
        finally:
            free(spark, made)
    return run


def _run_stages(
    raw: DataFrame, tables: Tables, run: Run, stages: Sequence[str], config: Mapping, rules: Sequence[Mapping], made: list[str]
) -> None:
    """``run_pipeline``; ``made`` has the scratch tables written so far, those nothing reads any more are deleted from it."""
    spark = raw.sparkSession
    steps = {"ingest": _ingest, "clean": _clean, "enrich": _enrich, "load": _load}
    checkpoints = config.get("checkpoints", CHECKPOINTS)
    severities = config.get("dead_letter_severities", {})
    rows, size, nulls, failure, edge_steps = raw, 0, None, None, []
    for stage in [s for s in STAGES if s in stages]:
        begin, earlier = time.monotonic(), len(made)
        missing = clean.missing_columns(rows, config.get("required_columns", {}).get(stage, ()))
        warning = f"missing columns: {', '.join(missing)}" if missing else None
        try:
            if nulls is None:
                good = F.col(files.MALFORMED).isNull() if files.MALFORMED in raw.columns else F.lit(True)
                fills = clean.null_counters(raw, config.get("null_fill"), good)
                rows, seen = settle_counted(raw, "ingested", **{f"null_{c}": n for c, n in fills.items()})
                size, nulls = seen["rows"], {c: seen[f"null_{c}"] for c in fills}
            out, left, dead = steps[stage](rows, size, tables, run, config)
            extra = config.get("extra_steps", {}).get(stage, ())
            for name in extra:
                out = registry.step(name)(out, config.get(name, {}))
            if extra:
                out, seen = settle_counted(out, stage)
                left = seen["rows"]
            _checkpoint(out, checkpoints.get(stage), tables, run, rules)
            if severities.get(stage):
                out, left, bad = _bury_broken(out, stage, checkpoints.get(stage), severities[stage], tables, run, rules)
                dead += bad
            run.record(stage, "SUCCESS", (size, left, dead), time.monotonic() - begin, warning)
            edge_steps.append(stage)
            rows, size = out, left
        except Exception as error:
            failure, text, dead = error, str(error), 0
            try:
                deadletter.write(rows, tables.path("dead_letters"), text, run.batch_id, stage)
                dead = size
            except Exception as more:
                text = f"{text}\nthe input could not be kept: {more}"
            run.record(stage, "FAILED", (size, 0, dead), time.monotonic() - begin, text)
            break
        if stage in SETTLING:
            with suppress(Exception):  # no failure of the stage; tried again when the run ends
                free(spark, made[:earlier])
                del made[:earlier]
    try:
        if edge_steps:
            _write_lineage(raw, nulls or {}, edge_steps, tables, run, config)
    except Exception as error:
        failure = failure or error
        run.record("lineage", "FAILED", (0, 0, 0), 0.0, str(error))
    tables.append(spark.createDataFrame(run.results, observability.RUN_SCHEMA), "pipeline_runs")
    if failure is not None:
        raise RuntimeError(f"pipeline failed, see pipeline_runs of batch {run.batch_id}") from failure


# Each step takes written rows and their number; it returns rows, their number, and how many it buried.

def _ingest(raw: DataFrame, size: int, tables: Tables, run: Run, config: Mapping) -> tuple[DataFrame, int, int]:
    if files.MALFORMED not in raw.columns:
        return raw, size, 0
    good, bad = files.split_malformed(raw)
    dead = deadletter.write(bad, tables.path("dead_letters"), "malformed_line", run.batch_id, "Ingest")
    return good, size - dead, dead


def _clean(raw: DataFrame, size: int, tables: Tables, run: Run, config: Mapping) -> tuple[DataFrame, int, int]:
    typed, failed = typed_stage(raw, config)
    path = tables.path("dead_letters")
    rejects, (kept, duplicates, left, repeats) = at_once(
        lambda: deadletter.write(failed, path, "type_cast_failure", run.batch_id, "TypeCast"),
        lambda: clean.dedup_settled(typed, **dedup_options(config)),
    )
    # not beside the other: two jobs must not commit to the same folder at once
    deadletter.write(duplicates, path, "duplicate_trade_id", run.batch_id, "Dedup")
    return kept, left, rejects + repeats


def _enrich(cleaned: DataFrame, size: int, tables: Tables, run: Run, config: Mapping) -> tuple[DataFrame, int, int]:
    rows, seen = settle_counted(enrich_stage(cleaned, config), "enriched")
    return rows, seen["rows"], 0


def _load(enriched: DataFrame, size: int, tables: Tables, run: Run, config: Mapping) -> tuple[DataFrame, int, int]:
    score = next(reversed(run.scores.values()), None)
    buckets = config.get("fact_buckets", BUCKETS)
    rejected = load_star(enriched, tables, run.batch_id, run.pipeline_name, score, buckets)
    return enriched, size, rejected


def _checkpoint(
    df: DataFrame, checkpoint: str | None, tables: Tables, run: Run, rules: Sequence[Mapping]
) -> None:
    """Store violations and the score of a checkpoint, from one scan; rows are never removed."""
    chosen = quality.rules_for(checkpoint, rules) if checkpoint else []
    if not chosen:
        return
    spark, begin = df.sparkSession, time.monotonic()
    evaluation = quality.evaluate(df, chosen, run.batch_id)
    # all chosen rules have this stage; as a constant it needs no sort of the violations by folders
    found = quality.dated(evaluation.violations).withColumn("stage", F.lit(checkpoint))
    tables.append(found, "dq_violations", ("run_date", "batch_id", "stage"))
    scored = quality.checkpoint_scores(evaluation.counts(spark)).select(
        F.lit(run.batch_id).alias("batch_id"), "*",
        F.lit(time.monotonic() - begin).alias("duration_sec"),
        F.current_timestamp().alias("recorded_at"),
    )
    kept = scored.collect()  # one row per checkpoint
    tables.append(spark.createDataFrame(kept, scored.schema), "dq_scores")
    run.scores.update((r.checkpoint, r.dq_score) for r in kept)


def _bury_broken(
    df: DataFrame, stage: str, checkpoint: str | None, severities: Sequence[str], tables: Tables, run: Run,
    rules: Sequence[Mapping],
) -> tuple[DataFrame, int, int]:
    """Move rows whose worst broken rule has one of the severities to the dead letters."""
    chosen = quality.rules_for(checkpoint, rules) if checkpoint else []
    kept, broken, left = quality.settle_routed(df, chosen, severities)
    hidden = ["dq_route", "dq_rules"]
    reason = F.concat(F.lit("dq_failed: "), "dq_rules")
    dead = deadletter.write(broken, tables.path("dead_letters"), reason, run.batch_id, stage, without=hidden)
    return kept.drop(*hidden), left, dead


def _write_lineage(
    raw: DataFrame, nulls: Mapping[str, int], stages: Sequence[str], tables: Tables, run: Run, config: Mapping
) -> None:
    counts = raw.sparkSession.createDataFrame(
        [(run.batch_id, *row) for row in clean.fill_rows(nulls, config.get("null_fill"))], f"batch_id string, {clean.FILL_SCHEMA}"
    )
    edges = observability.emitted_edges(counts, F.current_timestamp(), set(raw.columns), config)
    edges = edges.where(F.col("stage").isin(list(stages)))
    tables.append(edges, "lineage_edges")
    if config.get("keep_lineage_graph"):
        lineage.GraphStore(raw.sparkSession, tables.path("lineage_graph")).fold(edges)


# --- star schema on disk -----------------------------------------------------

def load_star(
    enriched: DataFrame, tables: Tables, batch_id: str, pipeline_name: str = PIPELINE_NAME,
    dq_score: float | None = None, buckets: int = BUCKETS,
) -> int:
    """Append new dimension members and facts; returns how many rows were rejected.

    See ``facts.FactStore`` for how facts are kept and replaced.
    """
    spark, store = enriched.sparkSession, FactStore(enriched.sparkSession, tables, buckets)
    valid, rejects = star.split_by_constraints(enriched)
    start = store.last_key()
    stamps = {"created_at": F.current_timestamp(), "updated_at": F.current_timestamp()}

    def add_members(name: str, build: Callable, extra: dict) -> None:
        members = build(enriched, tables.read(spark, name)).withColumns(extra)
        # settled first: the table it is compared with is the one it is added to
        settle(members, name).write.mode("append").parquet(tables.path(name))

    def bury_rejects() -> int:
        path = tables.path("dead_letters")
        return deadletter.write(rejects.drop("constraint_reason"), path, "constraint_violation", batch_id, "WriteStarSchema")

    rejected, keys, *_ = at_once(
        bury_rejects,
        lambda: star.trade_keys(valid, start),
        lambda: add_members("dim_product", star.dim_product, stamps),
        lambda: add_members("dim_counterparty", star.dim_counterparty, stamps),
        lambda: add_members("dim_date", star.dim_date, {}),
    )
    staged = star.fact_trades(
        valid, keys, tables.read(spark, "dim_product"), tables.read(spark, "dim_counterparty"),
        batch_id, pipeline_name, store.spread,
    ).withColumns(
        {"loaded_at": F.current_timestamp(), "dq_score_at_load": F.lit(dq_score).cast("double")}
    )
    load_id = store.next_load()
    store.replace(valid, load_id)
    last = store.append(staged, load_id)
    store.commit(load_id, batch_id, max(start, last))
    return rejected


@registry.register("write_star")
def _write_star(rows: DataFrame, options: Mapping) -> DataFrame:
    """Load enriched rows into the star schema at ``root`` as ``batch_id`` and pass them on."""
    load_star(rows, Tables(options["root"]), options["batch_id"], options.get("pipeline_name", PIPELINE_NAME))
    return rows


def current_facts(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """The visible facts: rows of finished loads that no finished load replaced."""
    found = FactStore(spark, tables).current()
    return None if found is None else found.drop("bucket")
