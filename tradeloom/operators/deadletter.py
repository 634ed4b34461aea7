"""Rows that could not be processed, kept with the reason and reprocessable.

Dead letters of all stages share one table partitioned by batch and stage.
Their columns are stored as text, since stages see the same column with
different types; ``read`` casts them back when given a schema.
"""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tradeloom.functions.fixed_values import DEAD_LETTER_COLUMNS
from tradeloom.functions.staging import watched

PARTITIONS = ["_dlq_batch_id", "_dlq_stage"]


def tag(
    df: DataFrame, reason: str | Column, batch_id: str | Column, stage: str,
    ts: Column | None = None,
) -> DataFrame:
    """Add the four dead-letter columns."""
    text = F.lit(reason) if isinstance(reason, str) else reason
    return df.withColumns(
        {
            "_dlq_batch_id": F.lit(batch_id) if isinstance(batch_id, str) else batch_id,
            "_dlq_stage": F.lit(stage),
            "_dlq_reason": text,
            "_dlq_ts": F.current_timestamp() if ts is None else ts,
        }
    )


def write(
    df: DataFrame, path: str, reason: str | Column, batch_id: str, stage: str, without: Sequence[str] = ()
) -> int:
    """Append rows to the dead-letter table and return their number, as the write counted it.

    Columns in ``without`` may be used by the reason and are not stored. Rows are counted
    before they are tagged: a batch and stage that are constants up to the write need no
    sort of the rows by their folders.
    """
    texts = [F.col(c).cast("string").alias(c) for c in df.columns if c not in without]
    rows, seen = watched(df)
    rows = tag(rows, reason, batch_id, stage).select(*texts, *DEAD_LETTER_COLUMNS)
    rows.write.mode("append").partitionBy(*PARTITIONS).parquet(path)
    return seen.get["rows"]


def route(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """Split rows by a condition; an unknown (null) condition means not failed."""
    bad = F.coalesce(failed, F.lit(False))
    return df.where(~bad), df.where(bad)


def route_keys(df: DataFrame, keys: DataFrame, key_col: str) -> tuple[DataFrame, DataFrame]:
    """Split rows by membership of their key in a table of failed keys."""
    wanted = keys.select(key_col).distinct()
    return df.join(wanted, key_col, "left_anti"), df.join(wanted, key_col, "left_semi")


def read(
    spark: SparkSession,
    path: str,
    batch_id: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Dead letters of one batch or all; only that batch's folders are listed."""
    columns = list(schema) if schema is not None else []
    texts = [StructField(c, StringType()) for c in (*PARTITIONS, "_dlq_reason")]
    full = StructType(
        [StructField(f.name, StringType()) for f in columns]
        + [*texts, StructField("_dlq_ts", TimestampType())]
    )
    reader = spark.read.schema(full) if columns else spark.read.option("mergeSchema", "true")
    try:
        found = reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        found = spark.createDataFrame([], full)
    found = found.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in columns})
    return found if batch_id is None else found.where(F.col("_dlq_batch_id") == batch_id)


def count_by_batch(dead: DataFrame) -> DataFrame:
    return dead.groupBy("_dlq_batch_id", "_dlq_stage").agg(F.count("*").alias("records"))


def reprocess(dead: DataFrame, fix: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Strip the dead-letter columns and run the rows through ``fix``."""
    return dead.drop(*DEAD_LETTER_COLUMNS).transform(fix)


def run_or_bury(
    df: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame], None],
    path: str,
    batch_id: str,
    stage: str,
) -> None:
    """Run a step and its sink; if either fails, keep the whole input and re-raise."""
    try:
        sink(step(df))
    except Exception as error:
        write(df, path, str(error), batch_id, stage)
        raise
