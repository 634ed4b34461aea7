from datetime import datetime

from conftest import rows

from tradeloom.operators import enrich
from tradeloom.plans import pipeline


def test_fx_convert(spark):
    df = spark.createDataFrame(
        [(100.0, "eur"), (100.0, "XYZ"), (100.0, None), (None, "JPY")], "notional double, currency string"
    )
    out = enrich.fx_convert(df, rates_override={"jpy": 0.01})
    rates = {r.currency: r.fx_rate_to_usd for r in out.collect()}
    assert rates == {"eur": 1.085, "XYZ": 1.0, None: 1.0, "JPY": 0.01}
    eur = out.where("currency = 'eur'").first()
    assert eur.notional_usd == 100.0 * 1.085 and eur.notional_eur == eur.notional_usd / 1.085
    assert enrich.fx_convert(df, source_col="amount").columns == df.columns


def test_date_expand(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 5, 31), datetime(2026, 6, 2)), (None, None)],
        "trade_date timestamp_ntz, settlement_date timestamp_ntz",
    )
    sunday = enrich.date_expand(df).where("trade_date IS NOT NULL").first()
    assert (sunday.trade_year, sunday.trade_quarter, sunday.trade_month) == (2026, 2, 5)
    assert sunday.trade_day_of_week == 1 and sunday.is_month_end and not sunday.is_trading_day
    assert sunday.days_to_settlement == 2
    assert "days_to_settlement" not in enrich.date_expand(df.drop("settlement_date")).columns


def test_lei_lookup_built_in_and_from_file(spark, tmp_path):
    df = spark.createDataFrame([("CP001", 5.0), ("CP9", 6.0), (None, 7.0)], "party string, notional double")
    out = enrich.lei_lookup(df, "party")
    assert rows(out, "party", "lei_country") == [("CP001", "US"), ("CP9", None), (None, None)]
    path = tmp_path / "entities.csv"
    path.write_text("counterparty_id,lei_code,legal_entity_name,lei_country,credit_rating\nCP9,L9,Nine,SE,B\n")
    config = {"lei_lookup": {"lookup_path": str(path), "counterparty_col": "party"}}
    found = pipeline.attribute_stage(df.selectExpr("*", "'USD' AS currency"), config)
    assert rows(found, "party", "legal_entity_name") == [("CP001", None), ("CP9", "Nine"), (None, None)]
    assert enrich.lei_lookup(df, "absent").columns == df.columns
