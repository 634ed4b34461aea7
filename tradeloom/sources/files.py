"""Reading feeds and stored tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A line that does not fit the schema, and its file; null for a good line.
MALFORMED, SOURCE_FILE = "_malformed_line", "_source_file"


def read_feed(
    spark: SparkSession, path: str, schema: str | None = None, infer: bool = False, keep_malformed: bool = False
) -> DataFrame:
    """Read a feed by its suffix: ``.parquet`` or ``.csv`` with a header.

    CSV needs a schema unless ``infer`` asks for an extra pass over the data.
    ``keep_malformed`` (CSV with a schema) adds the raw text and the file of every line
    with too few or too many fields, or a field that is not of its type; write the rows
    before ``split_malformed``. A missing path raises FileNotFoundError, another suffix
    ValueError.
    """
    if keep_malformed and not (schema and path.endswith(".csv")):
        raise ValueError("malformed lines are kept for CSV with a schema")
    if path.endswith(".parquet"):
        reader, load = spark.read, "parquet"
    elif path.endswith(".csv"):
        reader, load = spark.read.option("header", True), "csv"
        if keep_malformed:
            # Without column pruning, so that every line is held against the whole schema.
            reader = reader.schema(f"{schema}, {MALFORMED} string").options(
                mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, columnPruning=False
            )
        elif schema:
            reader = reader.schema(schema)
        elif infer:
            reader = reader.option("inferSchema", True)
    else:
        raise ValueError(f"unsupported feed format: {path}")
    try:
        found = getattr(reader, load)(path)
        if keep_malformed:
            bad = F.col(MALFORMED).isNotNull()
            found = found.withColumn(SOURCE_FILE, F.when(bad, F.col("_metadata.file_path")))
        return found
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise


def split_malformed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and (raw_line, source_file) of the malformed ones, of a written feed."""
    bad = F.col(MALFORMED).isNotNull()
    return (
        rows.where(~bad).drop(MALFORMED, SOURCE_FILE),
        rows.where(bad).select(F.col(MALFORMED).alias("raw_line"), F.col(SOURCE_FILE).alias("source_file")),
    )


def newest_feed(spark: SparkSession, folder: str, prefix: str = "trades_") -> str | None:
    """Path of the feed whose name sorts last; only file names are listed."""
    name = F.regexp_extract("path", rf"({prefix}[^/]*\.csv)", 1)
    try:
        listed = spark.read.format("binaryFile").load(f"{folder}/{prefix}*.csv")
        newest = listed.select(name.alias("name")).agg(F.max("name")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return f"{folder}/{newest}"


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV; timestamps as ``yyyy-MM-dd HH:mm:ss`` text."""
    texts = {
        name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        for name, kind in df.dtypes
        if kind.startswith("timestamp")
    }
    df.withColumns(texts).write.option("header", True).csv(path)
