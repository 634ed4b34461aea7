"""Counterparty and asset-class exposure, running totals, net positions.

Totals are computed by grouped aggregation and joined back to the rows. A
window over a counterparty would put all its trades in one task.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.money import exact_sum, micros, overflow, to_amount
from tradeloom.functions.ordering import exclusive_prefix, slice_of
from tradeloom.functions.relations import attach
from tradeloom.functions.staging import at_once, settle

GROUP_KEYS = ("counterparty_id", "product_id", "asset_class")
PAIR = ["counterparty_id", "product_id"]

#: Adds columns to rows, each from its own row, and changes none of those that order or group them.
RowStep = Callable[[DataFrame], DataFrame]


def _same(rows: DataFrame) -> DataFrame:
    return rows


def _side(side: str) -> Column:
    return F.when(F.upper("direction") == side, F.col("notional_usd")).otherwise(F.lit(0.0))


def _sums(df: DataFrame, keys: Sequence[str], amounts: dict[str, Column]) -> DataFrame:
    """Rows, amounts and exact partial sums per group."""
    measures = [F.count("*").alias("trades"), F.count("notional_usd").alias("amounts")]
    for name, amount in amounts.items():
        measures.append(F.sum(micros(amount)).alias(f"{name}_micros"))
        measures.append(F.sum(overflow(amount)).alias(f"{name}_overflow"))
    return df.groupBy(*keys).agg(*measures)


@dataclass
class Summary:
    """Written partial sums that all totals are derived from."""

    groups: DataFrame


def exposure_summary(df: DataFrame) -> Summary:
    """Sums per counterparty, product and class."""
    usd = {"usd": F.col("notional_usd")}
    sides = {"buy": _side("BUY"), "sell": _side("SELL")} if "direction" in df.columns else {}
    keys = [k for k in GROUP_KEYS if k in df.columns]
    return Summary(settle(_sums(df, keys, {**usd, **sides}), "groups"))


def _total(name: str) -> Column:
    return to_amount(F.sum(f"{name}_micros"), F.sum(f"{name}_overflow"))


def exposure_rollup(
    df: DataFrame, summary: Summary | None = None, price: RowStep = _same, describe: RowStep = _same
) -> DataFrame:
    """Add counterparty totals, counts, running totals and asset-class totals.

    For ``price`` and ``describe`` see ``running_exposure``.
    """
    priced = price(df)
    if not {"notional_usd", "counterparty_id", "trade_date"} <= set(priced.columns):
        return describe(priced)
    summary = summary or exposure_summary(priced)
    totals = {
        "counterparty_id": [
            _total("usd").alias("cpty_total_notional_usd"),
            F.sum("trades").alias("cpty_trade_count"),
        ]
    }
    if "asset_class" in priced.columns:
        totals["asset_class"] = [_total("usd").alias("asset_class_exposure_usd")]
    out, *written = at_once(
        lambda: running_exposure(df, summary=summary, price=price, describe=describe),
        *[lambda k=k: settle(summary.groups.groupBy(k).agg(*totals[k]), k) for k in totals],
    )
    for key, table in zip(totals, written):
        out = attach(out, table, [key])
    return out


def running_exposure(
    df: DataFrame,
    tie_break: Sequence[str] = ("trade_id",),
    summary: Summary | None = None,
    price: RowStep = _same,
    describe: RowStep = _same,
) -> DataFrame:
    """Add ``running_notional_usd``: the counterparty's total up to this row.

    Rows are ordered by trade date, then by the MD5 of the tie-break columns,
    then by those columns. The order is cut into slices of about equal size; a window
    adds up the rows of one counterparty inside one slice, and the total of its earlier
    slices (one row per counterparty and slice) is added to it. A counterparty
    with any number of rows, on one date or many, is cut by the slices. Whole rows are
    shuffled once; the totals read the ordering columns and the amount only.

    ``price`` makes the amount, ``describe`` columns that are not needed here. The columns
    they add are not shuffled: rows are priced after the shuffle and described once summed.
    """
    priced = price(df)
    names = [*describe(priced).columns, "running_notional_usd"]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in tie_break]
    spread = F.md5(F.concat_ws("|", *texts))
    order = ["trade_date", "_spread", *tie_break]
    trades = (summary or exposure_summary(priced)).groups.agg(F.sum("trades")).first()[0] or 0
    slice_ = slice_of(df, [F.col("counterparty_id"), F.col("trade_date"), spread], trades)
    cell = ["counterparty_id", "_slice"]
    measures = ["usd_micros", "usd_overflow", "amounts"]
    sums = _sums(priced.withColumn("_slice", slice_), cell, {"usd": F.col("notional_usd")})
    before = exclusive_prefix(sums, ["counterparty_id"], ["_slice"], measures).select(
        *cell, *[f"_before_{m}" for m in measures]
    )
    window = (
        Window.partitionBy(*cell)
        .orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    amount = F.col("notional_usd")
    # the MD5 is made after the shuffle
    placed = price(df.withColumn("_slice", slice_).repartition(*cell)).withColumn("_spread", spread)
    inside = placed.withColumns(
        {
            "_micros": F.sum(micros(amount)).over(window),
            "_overflow": F.sum(overflow(amount)).over(window),
            "_amounts": F.count(amount).over(window),
        }
    )
    summed = attach(inside, settle(before, "before"), cell)
    running = to_amount(
        F.col("_before_usd_micros") + F.coalesce("_micros", F.lit(0)),
        F.col("_before_usd_overflow") + F.coalesce("_overflow", F.lit(0.0)),
    )
    return describe(
        summed.withColumn(
            "running_notional_usd",
            F.when(F.col("_before_amounts") + F.col("_amounts") > 0, running),
        )
    ).select(*names)


def position_net(df: DataFrame) -> DataFrame:
    """Bought, sold and net USD notional per counterparty and product."""
    return df.groupBy(*PAIR).agg(
        exact_sum(_side("BUY")).alias("buy_notional_usd"),
        exact_sum(_side("SELL")).alias("sell_notional_usd"),
        (exact_sum(_side("BUY")) - exact_sum(_side("SELL"))).alias("net_notional_usd"),
    )


def position_net_rows(df: DataFrame, summary: Summary | None = None) -> DataFrame:
    """Add the net position of the trade's counterparty and product to each row."""
    if not {"notional_usd", "direction", "counterparty_id", "product_id"} <= set(df.columns):
        return df
    return attach(df, net_totals(summary or exposure_summary(df)), PAIR)


def net_totals(summary: Summary) -> DataFrame:
    """``position_net`` from the written partial sums."""
    net = summary.groups.groupBy(*PAIR).agg(
        _total("buy").alias("buy_notional_usd"),
        _total("sell").alias("sell_notional_usd"),
        (_total("buy") - _total("sell")).alias("net_notional_usd"),
    )
    return settle(net, "net")


def exposures(df: DataFrame, price: RowStep = _same, describe: RowStep = _same) -> DataFrame:
    """``exposure_rollup`` and ``position_net_rows`` from one summary."""
    summary = exposure_summary(price(df))
    rolled, net = at_once(lambda: exposure_rollup(df, summary, price, describe), lambda: net_totals(summary))
    return attach(rolled, net, PAIR)
