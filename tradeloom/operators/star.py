"""Star schema of trades: dimensions, facts, constraints and views."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import STATUS_SCHEMA, STATUSES, UNKNOWN_STATUS_KEY
from tradeloom.functions.money import exact_sum
from tradeloom.functions.ordering import number_rows
from tradeloom.functions.relations import fixed_rows
from tradeloom.functions.staging import settle

DIRECTIONS = ["BUY", "SELL", "UNKNOWN"]
STAGED_COLUMNS = [
    "trade_id", "product_id", "counterparty_id", "trade_date", "settlement_date",
    "settlement_status", "notional", "quantity", "currency", "direction", "notional_usd",
    "notional_eur", "fx_rate_to_usd", "buy_notional_usd", "sell_notional_usd",
    "net_notional_usd", "cpty_total_notional_usd", "cpty_trade_count", "running_notional_usd",
    "asset_class_exposure_usd", "trade_year", "trade_quarter", "trade_month",
    "trade_day_of_week", "is_month_end", "is_trading_day", "days_to_settlement",
]
MEASURES = STAGED_COLUMNS[STAGED_COLUMNS.index("notional_usd"):]


def _no_text(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


# --- dimensions --------------------------------------------------------------

def _distinct(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows; their number is asked for, or the optimizer would leave the step out before a maximum."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0").drop("_n")


def product_members(trades: DataFrame) -> DataFrame:
    """One row per product with the attributes seen in its trades.

    Distinct attribute values are found first, by hash; the maxima of text,
    which need sorted input, then run over those few rows only.
    """
    return (
        _distinct(trades.where(F.col("product_id").isNotNull()), "product_id", "asset_class", "currency", "exchange")
        .groupBy("product_id")
        .agg(
            F.coalesce(F.max("asset_class"), F.lit("UNKNOWN")).alias("asset_class"),
            F.coalesce(F.max("currency"), F.lit("USD")).alias("currency"),
            F.coalesce(F.max("exchange"), F.lit("UNKNOWN")).alias("exchange"),
        )
    )


def counterparty_members(trades: DataFrame) -> DataFrame:
    """One row per counterparty; its id stands in for an unknown name."""
    known = trades.where(F.col("counterparty_id").isNotNull())
    return (
        _distinct(known, "counterparty_id", "legal_entity_name", "lei_code", "lei_country", "credit_rating")
        .groupBy("counterparty_id")
        .agg(
            F.coalesce(F.max("legal_entity_name"), F.col("counterparty_id")).alias("legal_entity_name"),
            F.max("lei_code").alias("lei_code"),
            F.max("lei_country").alias("lei_country"),
            F.max("credit_rating").alias("credit_rating"),
        )
    )


def new_members(members: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Members the dimension does not hold yet; known ones are never changed."""
    return members.join(existing.select(key), key, "left_anti")


def _next_key(existing: DataFrame | None, key: str) -> int:
    if existing is None:
        return 0
    return existing.agg(F.max(key)).first()[0] or 0


def dim_product(trades: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New rows of the product dimension, numbered after the existing ones."""
    members = product_members(trades)
    if existing is not None:
        members = new_members(members, existing, "product_id")
    numbered = number_rows(members, ["product_id"], "product_key", _next_key(existing, "product_key"))
    return numbered.select(
        F.col("product_key").cast("int"), "product_id", F.col("product_id").alias("ticker"),
        _no_text("isin"), _no_text("cusip"), _no_text("sedol"),
        "asset_class", _no_text("sub_asset_class"), "currency", "exchange",
        _no_text("country"), F.lit(True).alias("is_active"),
    )


def dim_counterparty(trades: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New rows of the counterparty dimension, numbered after the existing ones."""
    members = counterparty_members(trades)
    if existing is not None:
        members = new_members(members, existing, "counterparty_id")
    numbered = number_rows(
        members, ["counterparty_id"], "counterparty_key", _next_key(existing, "counterparty_key")
    )
    return numbered.select(
        F.col("counterparty_key").cast("int"), "counterparty_id", "legal_entity_name",
        "lei_code", "lei_country", "credit_rating", _no_text("rating_agency"),
        _no_text("country"), _no_text("city"), _no_text("entity_type"),
        F.lit(False).alias("is_internal"), F.lit(True).alias("is_active"),
    )


def date_key(moment: str) -> Column:
    return F.date_format(moment, "yyyyMMdd").cast("int")


def dim_date(trades: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Calendar rows of all trade and settlement dates; Monday is day 1."""
    days = (
        trades.select(F.explode(F.array("trade_date", "settlement_date")).alias("moment"))
        .select(F.to_date("moment").alias("calendar_date"))
        .where(F.col("calendar_date").isNotNull())
        .distinct()
    )
    d = F.col("calendar_date")
    last = d == F.last_day(d)
    weekday = F.weekday(d) + 1
    rows = days.select(
        date_key("calendar_date").alias("date_key"),
        "calendar_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        last.alias("is_month_end"),
        (last & F.month(d).isin(3, 6, 9, 12)).alias("is_quarter_end"),
        (last & (F.month(d) == 12)).alias("is_year_end"),
        weekday.between(1, 5).alias("is_trading_day"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
    )
    return rows if existing is None else new_members(rows, existing, "date_key")


def dim_settlement_status(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, STATUSES, STATUS_SCHEMA)


# --- facts -------------------------------------------------------------------

def resolve_keys(trades: DataFrame, products: DataFrame, counterparties: DataFrame) -> DataFrame:
    """Add dimension keys; unknown products and counterparties stay null.

    Statuses are fixed rows and broadcast. The other dimensions are stored
    tables, so their file size decides how they are joined.
    """
    status = dim_settlement_status(trades.sparkSession).select(
        "status_key", F.col("status_code").alias("_status")
    )
    return (
        trades.join(products.select("product_id", "product_key"), "product_id", "left")
        .join(counterparties.select("counterparty_id", "counterparty_key"), "counterparty_id", "left")
        .join(status, F.coalesce("settlement_status", F.lit("UNKNOWN")) == F.col("_status"), "left")
        .drop("_status")
        .withColumns(
            {
                "trade_date_key": date_key("trade_date"),
                "settlement_date_key": date_key("settlement_date"),
                "status_key": F.coalesce("status_key", F.lit(UNKNOWN_STATUS_KEY)),
                "currency": F.coalesce("currency", F.lit("USD")),
                "direction": F.coalesce("direction", F.lit("UNKNOWN")),
            }
        )
    )


def constraint_reason() -> Column:
    """Text of the first constraint a staged trade breaks, null if it is valid."""
    reason = F.lit(None).cast("string")
    required = ["quantity", "notional", "trade_id"]
    direction = F.coalesce("direction", F.lit("UNKNOWN"))
    reason = F.when(~direction.isin(DIRECTIONS), F.lit("direction_not_allowed")).otherwise(reason)
    for column in required:
        reason = F.when(F.col(column).isNull(), F.lit(f"{column}_missing")).otherwise(reason)
    return reason


def split_by_constraints(trades: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid trades, and rejected ones with a ``constraint_reason`` column.

    A trade id must be unique among the otherwise valid trades. Ids are counted in
    one partial aggregate; only those that repeat, a written table, are joined back.
    """
    reason = constraint_reason()
    repeated = settle(
        trades.where(reason.isNull()).groupBy(F.col("trade_id").alias("_repeated"))
        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_repeated"),
        "repeated",
    )
    again = F.when(F.col("_repeated").isNotNull(), F.lit("trade_id_not_unique"))
    marked = trades.join(repeated, F.col("trade_id") == F.col("_repeated"), "left").withColumn(
        "constraint_reason", F.coalesce(reason, again)
    ).drop("_repeated")
    return (
        marked.where(F.col("constraint_reason").isNull()).drop("constraint_reason"),
        marked.where(F.col("constraint_reason").isNotNull()),
    )


def trade_keys(trades: DataFrame, start_key: int = 0) -> DataFrame:
    """Keys of valid staged trades, counted by trade id after ``start_key``.

    Trade ids must be unique, as ``clean.dedup`` leaves them. Only the ids are
    sorted; ``fact_trades`` joins the keys to the rows.
    """
    return number_rows(trades.select("trade_id"), ["trade_id"], "trade_key", start_key)


def fact_trades(
    trades: DataFrame,
    keys: DataFrame,
    products: DataFrame,
    counterparties: DataFrame,
    batch_id: str,
    pipeline_name: str,
    spread: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Fact rows of valid staged trades; ``spread`` shuffles them as they are stored, before their keys are joined."""
    resolved = resolve_keys(trades, products, counterparties).select(
        "product_key", "counterparty_key", "trade_date_key", "settlement_date_key", "status_key",
        "trade_id", "notional", "quantity", "currency", "direction", *MEASURES,
    )
    rows = spread(resolved) if spread else resolved
    return rows.join(keys, "trade_id").select(
        "trade_key", *resolved.columns,
        F.lit(batch_id).alias("batch_id"), F.lit(pipeline_name).alias("pipeline_name"),
    )


def upsert_facts(existing: DataFrame, staged: DataFrame) -> DataFrame:
    """Existing facts with every staged trade id replaced by its staged row."""
    kept = existing.join(staged.select("trade_id"), "trade_id", "left_anti")
    return kept.unionByName(staged)


# --- views -------------------------------------------------------------------

def daily_counterparty_exposure(
    facts: DataFrame, dates: DataFrame, counterparties: DataFrame
) -> DataFrame:
    """Exposure per day, counterparty and currency.

    ``net_notional_usd`` is a group total repeated on each fact, so its sum
    counts a group several times; ``position_net`` gives the net position.
    """
    return (
        facts.join(dates.select("date_key", "calendar_date"), F.col("trade_date_key") == F.col("date_key"))
        .join(
            counterparties.select("counterparty_key", "legal_entity_name", "lei_code", "credit_rating"),
            "counterparty_key",
        )
        .groupBy("calendar_date", "legal_entity_name", "lei_code", "credit_rating", "currency")
        .agg(
            exact_sum(F.col("notional_usd")).alias("total_notional_usd"),
            exact_sum(F.col("notional_eur")).alias("total_notional_eur"),
            exact_sum(F.col("net_notional_usd")).alias("net_notional_usd"),
            F.count("*").alias("trade_count"),
        )
    )


def asset_class_exposure(facts: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Exposure per asset class, product currency, year and quarter."""
    return (
        facts.select("product_key", "trade_date_key", "counterparty_key", "notional_usd", "net_notional_usd")
        .join(products.select("product_key", "asset_class", "currency"), "product_key")
        .join(dates.select("date_key", "year", "quarter"), F.col("trade_date_key") == F.col("date_key"))
        .groupBy("asset_class", "currency", "year", "quarter")
        .agg(
            exact_sum(F.col("notional_usd")).alias("total_notional_usd"),
            exact_sum(F.col("net_notional_usd")).alias("net_notional_usd"),
            F.count("*").alias("trade_count"),
            F.countDistinct("counterparty_key").alias("unique_counterparties"),
        )
    )


def distinct_sketches(facts: DataFrame, products: DataFrame, column: str = "counterparty_key", log_size: int = 12) -> DataFrame:
    """HyperLogLog sketches of a fact column per day and asset class, to be stored.

    A sketch has up to 2^log_size registers; its relative standard error is about
    1.04 / sqrt(2^log_size), 1.6 % for 12. Few distinct values are counted exactly.
    """
    return (
        facts.select("product_key", "trade_date_key", column)
        .join(products.select("product_key", "asset_class"), "product_key")
        .groupBy("asset_class", "trade_date_key")
        .agg(F.hll_sketch_agg(column, log_size).alias("sketch"))
    )


def distinct_of_period(sketches: DataFrame, first_day: int, last_day: int, *by: str) -> DataFrame:
    """Approximate distinct values of any period (date keys, both included), from stored sketches only."""
    chosen = sketches.where(F.col("trade_date_key").between(first_day, last_day))
    return chosen.groupBy("asset_class", *by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))


def settlement_failures(
    facts: DataFrame, counterparties: DataFrame, products: DataFrame
) -> DataFrame:
    """Facts whose settlement failed, with counterparty and product attributes."""
    status = dim_settlement_status(facts.sparkSession).where("status_code = 'FAILED'")
    return (
        facts.join(F.broadcast(status.select("status_key", "status_label")), "status_key")
        .join(
            counterparties.select("counterparty_key", "legal_entity_name", "credit_rating"),
            "counterparty_key",
        )
        .join(products.select("product_key", "asset_class"), "product_key")
        .select(
            "trade_id", "trade_date_key", "notional_usd", "currency", "legal_entity_name",
            "credit_rating", "asset_class", "status_label", "days_to_settlement", "batch_id",
        )
    )
