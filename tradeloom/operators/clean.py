"""Cleaning: defaults for missing values, safe casts, one row per key."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.fixed_values import COLUMN_TYPES, NULL_DEFAULTS
from tradeloom.functions.staging import open_folders, settle, settle_counted

NULL_TEXT = "<null>"
UNORDERED_TYPES = ("map", "variant")
ROW_ID = "_row_id"


def _fills(df: DataFrame, fills: Mapping | None) -> dict:
    merged = {**NULL_DEFAULTS, **(fills or {})}
    return {c: v for c, v in merged.items() if c in df.columns}


def null_fill(df: DataFrame, fills: Mapping | None = None) -> DataFrame:
    """Replace nulls by the column's default, keeping the column's type."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(value).cast(types[c]))
            for c, value in _fills(df, fills).items()
        }
    )


FILL_SCHEMA = "column_name string, null_count bigint, fill_value string"


def null_counters(df: DataFrame, fills: Mapping | None, good: Column) -> dict[str, Column]:
    """An aggregate for each column that ``null_fill`` would fill: its nulls in good rows."""
    return {c: F.count_if(good & F.col(c).isNull()) for c in _fills(df, fills)}


def fill_rows(nulls: Mapping[str, int], fills: Mapping | None = None) -> list[tuple]:
    """Rows of ``null_fill_counts`` from counted nulls."""
    merged = {**NULL_DEFAULTS, **(fills or {})}
    return [(c, n, str(merged[c])) for c, n in nulls.items()]


def null_fill_counts(
    df: DataFrame, fills: Mapping | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Nulls per column that ``null_fill`` would replace, from a single scan."""
    chosen = _fills(df, fills)
    counts = df.groupBy(*by).agg(
        *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in chosen]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_n_{c}").alias("null_count"),
                F.lit(str(value)).alias("fill_value"),
            )
            for c, value in chosen.items()
        ]
    )
    return counts.select(*by, F.inline(rows))


def row_hash(df: DataFrame, name: str = "row_hash") -> DataFrame:
    """MD5 over all columns; a null is told apart from an absent value."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TEXT)) for c in df.columns]
    return df.withColumn(name, F.md5(F.concat_ws("|", *texts)))


def _casts(df: DataFrame, types: Mapping | None) -> dict[str, Column]:
    wanted = {**COLUMN_TYPES, **(types or {})}
    have = dict(df.dtypes)
    return {
        c: F.col(c).try_cast(t) for c, t in wanted.items() if c in have and have[c] != t
    }


def cast_columns(df: DataFrame, types: Mapping | None = None) -> DataFrame:
    """Cast to the canonical types; a value that does not fit becomes null."""
    return df.withColumns(_casts(df, types))


def type_cast(df: DataFrame, types: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast to the canonical types and set rows aside that do not fit.

    Returns (cast rows, rejected rows). Rejected rows keep their raw values and
    list the offending columns in ``_failed_columns``.
    """
    casts = _casts(df, types)
    failures = {c: F.col(c).isNotNull() & cast.isNull() for c, cast in casts.items()}
    failed = F.lit(False)
    for condition in failures.values():
        failed = failed | condition
    names = F.concat_ws(",", *[F.when(bad, F.lit(c)) for c, bad in failures.items()])
    return (
        df.where(~failed).withColumns(casts),
        df.where(failed).withColumn("_failed_columns", names),
    )


def _ranked(
    df: DataFrame, keys: Sequence[str], order_col: str, ascending: bool, tie_break: Sequence[str]
) -> DataFrame:
    """Add ``_rank``, the row's place within its key."""
    first = F.col(order_col).asc_nulls_first() if ascending else F.col(order_col).desc_nulls_last()
    rest = [
        f.name
        for f in df.schema
        if f.name not in {*keys, order_col, *tie_break}
        and f.dataType.typeName() not in UNORDERED_TYPES
    ]
    ties = [F.col(c).asc_nulls_first() for c in [*tie_break, *rest]]
    window = Window.partitionBy(*keys).orderBy(first, *ties)
    return df.withColumn("_rank", F.row_number().over(window))


def dedup(
    df: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    order_col: str = "trade_date",
    ascending: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Keep the latest (or earliest) row per key; null keys count as one key.

    Ties are settled by ``tie_break`` and then all other columns. Only one row
    per key leaves each map task (the optimizer limits the window group before
    the shuffle), so a hot key does not pile up.
    """
    if not {*keys, order_col} <= set(df.columns):
        return df
    ranked = _ranked(df, keys, order_col, ascending, tie_break)
    return ranked.where("_rank = 1").drop("_rank")


def dedup_split(
    df: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    order_col: str = "trade_date",
    ascending: bool = False,
    tie_break: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """The rows ``dedup`` keeps, and all others; no value is changed.

    The rows are written twice, once as they come and once in folders by their side.
    """
    if not {*keys, order_col} <= set(df.columns):
        return df, df.limit(0)
    return dedup_settled(settle(df, "typed"), keys, order_col, ascending, tie_break)[:2]


#: Keys are counted by hash buckets; a bucket with more rows, and four times the mean, may hold a hot key.
KEY_BUCKETS, HOT_ROWS = 1 << 16, 100_000


def _hot_buckets(df: DataFrame, keys: Sequence[str]) -> tuple[Column, list[int]]:
    """The hash bucket of a row's key, and the buckets with far more rows than others."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / F.lit(KEY_BUCKETS)  # one row a bucket
    hot = counts.withColumn("mean", mean).where((F.col("n") > HOT_ROWS) & (F.col("n") > 4 * F.col("mean")))
    return bucket, [r.bucket for r in hot.select("bucket").collect()]


def _marked(
    df: DataFrame, keys: Sequence[str], order_col: str, ascending: bool, tie_break: Sequence[str]
) -> DataFrame:
    """Every row with ``_won``, whether ``dedup`` keeps it.

    Rows are shuffled once by their key. Rows of hot buckets are written with a row id
    instead; ``dedup`` gives the id that wins each key, one row per key and map task being
    shuffled, and the ids are joined to the rows, so no hot key's rows meet in one task.
    """
    bucket, hot = _hot_buckets(df, keys)
    heavy = bucket.isin(hot) if hot else F.lit(False)
    first = F.col("_rank") == 1
    out = _ranked(df.where(~heavy), keys, order_col, ascending, tie_break).withColumn("_won", first).drop("_rank")
    if hot:
        rows = settle(df.where(heavy).withColumn(ROW_ID, F.monotonically_increasing_id()), "hot")
        sortable = [f.name for f in rows.schema if f.dataType.typeName() not in UNORDERED_TYPES]
        won = dedup(rows.select(*sortable), keys, order_col, ascending, [*tie_break]).select(ROW_ID)
        joined = rows.join(settle(won, "won").withColumn("_won", F.lit(True)), ROW_ID, "left").drop(ROW_ID)
        out = out.unionByName(joined.withColumn("_won", F.coalesce("_won", F.lit(False))))
    return out


def dedup_settled(
    df: DataFrame,
    keys: Sequence[str] = ("trade_id",),
    order_col: str = "trade_date",
    ascending: bool = False,
    tie_break: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, int, int]:
    """``dedup_split`` of written rows: both sides written by one job, and their row counts.

    The rows are read twice, at first the keys only.
    """
    if not {*keys, order_col} <= set(df.columns):
        rows, seen = settle_counted(df, "typed")
        return rows, rows.limit(0), seen["rows"], 0
    marked = _marked(df, keys, order_col, ascending, tie_break)
    with open_folders(df.sparkSession, 2):
        both, seen = settle_counted(marked, "deduplicated", ["_won"], kept=F.count_if("_won"))
    kept = seen["kept"]
    return both.where("_won").select(*df.columns), both.where("NOT _won").select(*df.columns), kept, seen["rows"] - kept


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the DataFrame lacks; a warning, never a block."""
    return [c for c in required if c not in df.columns]
