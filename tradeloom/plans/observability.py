"""Run metadata: per-stage record counts and the lineage a run emits."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import COLUMN_TYPES

RUN_SCHEMA = (
    "batch_id string, pipeline_name string, started_at timestamp, stage_name string, "
    "status string, records_in bigint, records_out bigint, records_dead bigint, "
    "records_dead_total bigint, duration_sec double, note string"
)
DATE_COLUMNS = [
    "days_to_settlement", "trade_year", "trade_quarter", "trade_month",
    "trade_day_of_week", "is_month_end", "is_trading_day",
]
ENTITY_COLUMNS = ["lei_code", "legal_entity_name", "lei_country", "credit_rating"]


def stage_counts(
    stages: Mapping[str, Mapping[str, Sequence[DataFrame]]], by: Sequence[str] = ()
) -> DataFrame:
    """Records in, out and dead per stage, dead also summed over earlier stages.

    ``stages`` maps a stage name to DataFrames under "in", "out" and "dead".
    All of them are counted in one aggregation.
    """
    roles = ["in", "out", "dead"]
    tagged = None
    for place, (stage, frames) in enumerate(stages.items()):
        for role in roles:
            for df in frames.get(role, ()):
                part = df.select(
                    *by,
                    F.lit(place).alias("stage_order"),
                    F.lit(stage).alias("stage_name"),
                    F.lit(role).alias("role"),
                )
                tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy(*by, "stage_order", "stage_name").agg(
        *[F.count_if(F.col("role") == r).alias(f"records_{r}") for r in roles]
    )
    # one row per batch and stage, so a window per batch stays as short as the pipeline
    so_far = Window.partitionBy(*by).orderBy("stage_order")
    return counts.withColumn("records_dead_total", F.sum("records_dead").over(so_far))


def latest_runs(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Stage runs, most recent first; all of them unless ``limit`` is given."""
    ordered = runs.orderBy(F.col("started_at").desc_nulls_last(), "batch_id", "stage_name")
    return ordered if limit is None else ordered.limit(limit)


def step_edges(columns: set[str] | None = None, config: Mapping | None = None) -> list[tuple[str, str, str, str]]:
    """(source, target, transform, stage) of every step, with its options, over a source's columns.

    A step emits edges only for columns that it had; ``columns`` None stands for all.
    """
    config = config or {}
    has = lambda *names: columns is None or set(names) <= columns
    casts = {**COLUMN_TYPES, **config.get("type_cast", {})}
    edges = [(f"raw.{c}", f"typed.{c}", "type_cast", "clean") for c in casts if has(c)]
    keys = config.get("dedup", {}).get("key_cols", ["trade_id"])
    if has(*keys):
        edges += [(f"typed.{c}", f"dedup.{c}", "dedup", "clean") for c in keys]
    amount = config.get("fx_convert", {}).get("source_col", "notional")
    date = config.get("date_expand", {}).get("date_col", "trade_date")
    party = config.get("lei_lookup", {}).get("counterparty_col", "counterparty_id")
    converted = has(amount)
    if converted:
        edges.append((f"clean.{amount}", "enriched.notional_usd", "fx_convert", "enrich"))
        edges.append(("enriched.notional_usd", "enriched.notional_eur", "fx_to_eur", "enrich"))
    if has(date):
        edges += [(f"clean.{date}", f"enriched.{c}", "date_expand", "enrich") for c in DATE_COLUMNS]
    if has(party):
        edges += [(f"clean.{party}", f"enriched.{c}", "lei_lookup", "enrich") for c in ENTITY_COLUMNS]
    if converted and has("counterparty_id", "trade_date"):
        edges.append(("enriched.notional_usd", "risk_report.usd_exposure", "exposure_rollup", "enrich"))
        edges.append(("risk_report.usd_exposure", "risk_report.eur_exposure", "eur_conversion", "enrich"))
    netted = converted and has("direction", "counterparty_id", "product_id")
    if netted:
        edges.append(("enriched.notional_usd", "enriched.net_notional_usd", "position_net", "enrich"))
    loaded = ["notional_usd", "notional_eur"] * converted + ["net_notional_usd"] * netted
    edges += [(f"enriched.{c}", f"fact_trades.{c}", "write_star_schema", "load") for c in loaded]
    return edges


def emitted_edges(
    null_counts: DataFrame, ts: Column, columns: set[str] | None = None, config: Mapping | None = None
) -> DataFrame:
    """Lineage edges of each batch in ``null_counts`` (batch_id, column_name, ...).

    A null_fill edge exists only for columns that had nulls in the batch; the
    other steps emit the same edges (``step_edges``) for every batch.
    """
    filled = null_counts.where("null_count > 0").select(
        "batch_id",
        F.concat(F.lit("raw."), "column_name").alias("source"),
        F.concat(F.lit("clean."), "column_name").alias("target"),
        F.lit("null_fill").alias("transform"),
        F.lit("clean").alias("stage"),
        F.to_json(F.struct("null_count", "fill_value")).alias("metadata"),
    )
    always = F.array(
        *[
            F.struct(
                F.lit(s).alias("source"), F.lit(t).alias("target"),
                F.lit(name).alias("transform"), F.lit(stage).alias("stage"),
                F.lit("{}").alias("metadata"),
            )
            for s, t, name, stage in step_edges(columns, config)
        ]
    )
    fixed = null_counts.select("batch_id").distinct().select("batch_id", F.inline(always))
    return filled.unionByName(fixed).withColumn("ts", ts)
