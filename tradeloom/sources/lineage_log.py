"""A lineage edge log derived from the part and line-item tables.

Parts form a binary tree of columns; every line item logs an edge from its
part's column to its supplier's column, so the same edge appears many times
with different transforms and batches.
"""

from pyspark.sql import DataFrame, SparkSession

from tradeloom.sources.trades import table


def node_sql(key: str) -> str:
    """Node name of an integer key; some layers are unknown, some nodes have none."""
    return (
        f"CONCAT(CASE {key} % 8 WHEN 0 THEN 'raw.' WHEN 1 THEN 'clean.' WHEN 2 THEN 'typed.' "
        f"WHEN 3 THEN 'dedup.' WHEN 4 THEN 'enriched.' WHEN 5 THEN 'risk_report.' "
        f"WHEN 6 THEN 'legacy.' ELSE '' END, 'c', CAST({key} AS VARCHAR(20)))"
    )


def node_name(key: int) -> str:
    layers = ["raw.", "clean.", "typed.", "dedup.", "enriched.", "risk_report.", "legacy.", ""]
    return f"{layers[key % 8]}c{key}"


LINEAGE_LOG_SQL = f"""
SELECT
  CONCAT('b_', CAST(p_size % 7 AS VARCHAR(20))) AS batch_id,
  {node_sql("CAST(FLOOR(p_partkey / 2) AS BIGINT)")} AS source,
  {node_sql("p_partkey")} AS target,
  CASE p_partkey % 3 WHEN 0 THEN 'null_fill' WHEN 1 THEN 'type_cast' ELSE 'fx_convert' END AS transform,
  CASE p_partkey % 2 WHEN 0 THEN 'clean' ELSE 'enrich' END AS stage,
  CAST('2020-01-01 00:00:00' AS TIMESTAMP_TYPE) + INTERVAL '1' SECOND * CAST(p_partkey AS INTEGER) AS ts,
  CONCAT('{{"part":"', CAST(p_partkey AS VARCHAR(20)), '"}}') AS metadata
FROM {{part}} WHERE p_partkey > 0
UNION ALL
SELECT
  CONCAT('b_', CAST(l_orderkey % 7 AS VARCHAR(20))) AS batch_id,
  {node_sql("l_partkey")} AS source,
  CONCAT('fact_trades.s', CAST(l_suppkey AS VARCHAR(20))) AS target,
  CASE l_linenumber WHEN 1 THEN 'write_star_schema' WHEN 2 THEN 'exposure_rollup'
       WHEN 3 THEN 'position_net' ELSE 'date_expand' END AS transform,
  'load' AS stage,
  l_shipdate + INTERVAL '1' MINUTE * l_linenumber AS ts,
  CONCAT('{{"line":"', CAST(l_linenumber AS VARCHAR(20)), '"}}') AS metadata
FROM {{lineitem}}
"""


def lineage_log(spark: SparkSession, folder: str) -> DataFrame:
    """Edges in the order-free form the lineage operators expect."""
    text = LINEAGE_LOG_SQL.replace("TIMESTAMP_TYPE", "TIMESTAMP_NTZ")
    table(spark, folder, "part").createOrReplaceTempView("_log_part")
    table(spark, folder, "lineitem").createOrReplaceTempView("_log_lineitem")
    return spark.sql(text.replace("{part}", "_log_part").replace("{lineitem}", "_log_lineitem"))


def lineage_log_sql() -> str:
    """The same log for an engine whose TIMESTAMP has no time zone."""
    return (
        LINEAGE_LOG_SQL.replace("TIMESTAMP_TYPE", "TIMESTAMP")
        .replace("{part}", "part").replace("{lineitem}", "lineitem")
    )
