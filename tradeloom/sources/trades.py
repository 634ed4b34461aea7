"""Trades derived from the order tables; the text is valid in any ANSI engine."""

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

RAW_TRADES_SQL = """
SELECT
  CONCAT('T_', CAST(l_orderkey AS VARCHAR(20)), '_', CAST(l_linenumber AS VARCHAR(20))) AS trade_id,
  CASE WHEN l_suppkey % 97 = 0 THEN NULL ELSE CONCAT('PROD', LPAD(CAST(l_partkey % 10 + 1 AS VARCHAR(20)), 3, '0')) END AS product_id,
  CONCAT('CP', LPAD(CAST(o_custkey % 6 + 1 AS VARCHAR(20)), 3, '0')) AS counterparty_id,
  CASE l_partkey % 5 WHEN 0 THEN 'Equity' WHEN 1 THEN 'FX' WHEN 2 THEN 'Rates' WHEN 3 THEN 'Credit' ELSE 'Commodity' END AS asset_class,
  CASE WHEN l_partkey % 50 = 0 THEN 'XYZ' WHEN l_partkey % 49 = 0 THEN NULL
       ELSE CASE l_suppkey % 7 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'gbp' WHEN 3 THEN 'JPY' WHEN 4 THEN 'CHF' WHEN 5 THEN 'CAD' ELSE 'AUD' END END AS currency,
  CASE l_returnflag WHEN 'R' THEN 'SELL' WHEN 'A' THEN 'buy' ELSE CASE WHEN l_linenumber = 7 THEN NULL ELSE 'BUY' END END AS direction,
  CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 103 = 0 THEN 'abc'
       WHEN l_partkey % 107 = 0 THEN CAST(-CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(30))
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(30)) END AS notional,
  l_quantity AS quantity,
  l_shipdate AS trade_date,
  l_shipdate + INTERVAL '1' DAY * CAST(l_orderkey % 7 - 1 AS INTEGER) AS settlement_date,
  CASE o_orderstatus WHEN 'F' THEN 'SETTLED' WHEN 'P' THEN 'PENDING' ELSE CASE WHEN l_linenumber = 1 THEN 'FAILED' ELSE 'CANCELLED' END END AS settlement_status,
  CASE l_suppkey % 6 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'LSE' WHEN 2 THEN 'TSE' WHEN 3 THEN 'XETRA' WHEN 4 THEN 'SGX' ELSE 'ASX' END AS exchange,
  l_suppkey AS src_suppkey, l_partkey AS src_partkey
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The uncleaned trades, with every fault the cleaning steps deal with."""
    return spark.sql(
        RAW_TRADES_SQL,
        lineitem=table(spark, folder, "lineitem"),
        orders=table(spark, folder, "orders"),
    )
