"""Enrichment: currency conversion, calendar attributes, legal entities."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import FX_TO_USD, LEGAL_ENTITIES, LEGAL_ENTITY_SCHEMA
from tradeloom.functions.relations import fixed_rows

LEGAL_ENTITY_COLUMNS = ["lei_code", "legal_entity_name", "lei_country", "credit_rating"]


def fx_convert(
    df: DataFrame,
    source_col: str = "notional",
    currency_col: str = "currency",
    rates_override: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``fx_rate_to_usd``, ``notional_usd`` and ``notional_eur``."""
    if source_col not in df.columns:
        return df
    rates = {**FX_TO_USD, **{k.upper(): v for k, v in (rates_override or {}).items()}}
    table = F.create_map(*[F.lit(x) for item in rates.items() for x in item])
    rate = F.coalesce(F.try_element_at(table, F.upper(currency_col)), F.lit(1.0))
    return (
        df.withColumn("fx_rate_to_usd", rate)
        .withColumn("notional_usd", (F.col(source_col) * F.col("fx_rate_to_usd")).cast("double"))
        .withColumn("notional_eur", F.col("notional_usd") / F.lit(float(rates["EUR"])))
    )


def date_expand(
    df: DataFrame, date_col: str = "trade_date", settle_col: str = "settlement_date"
) -> DataFrame:
    """Add calendar attributes of the trade date (Sunday is day 1)."""
    if date_col not in df.columns:
        return df
    weekday = F.dayofweek(date_col)
    added = {
        "trade_year": F.year(date_col),
        "trade_quarter": F.quarter(date_col),
        "trade_month": F.month(date_col),
        "trade_day_of_week": weekday,
        "is_month_end": F.dayofmonth(date_col) == F.dayofmonth(F.last_day(date_col)),
        "is_trading_day": weekday.between(2, 6),
    }
    if settle_col in df.columns:
        added["days_to_settlement"] = F.datediff(settle_col, date_col)
    return df.withColumns(added)


def lei_lookup(
    df: DataFrame,
    counterparty_col: str = "counterparty_id",
    reference: DataFrame | None = None,
    reference_key: str = "counterparty_id",
) -> DataFrame:
    """Left-join legal-entity columns; unknown counterparties get nulls.

    Of reference rows that repeat a key the first in column order counts, so a
    trade is never doubled.

    The built-in table has a fixed size and is broadcast. A ``reference`` read
    from a file is joined without a hint: its file size decides.
    """
    if counterparty_col not in df.columns:
        return df
    if reference is None:
        fixed = fixed_rows(df.sparkSession, LEGAL_ENTITIES, LEGAL_ENTITY_SCHEMA)
        renamed = fixed.select(F.col("counterparty_id").alias("_entity_id"), *LEGAL_ENTITY_COLUMNS)
    else:
        renamed = reference.select(F.col(reference_key).alias("_entity_id"), *LEGAL_ENTITY_COLUMNS)
        first = F.min(F.struct(*LEGAL_ENTITY_COLUMNS)).alias("_first")
        renamed = renamed.groupBy("_entity_id").agg(first).select("_entity_id", "_first.*")
    match = F.col(counterparty_col) == F.col("_entity_id")
    return df.join(renamed, match, "left").drop("_entity_id")
