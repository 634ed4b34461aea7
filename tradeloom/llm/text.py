"""Helpers shared by the text operators."""

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = b" \t\n\r\x0b\x0c"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(docs: DataFrame) -> DataFrame:
    """doc_id and text only; a null text becomes the empty one."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's decimal text modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(df: DataFrame) -> list[str]:
    """All columns of ``df``, for select."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes, nulls as empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [x or b"" for x in column.to_pylist()]


def in_arrow(df: DataFrame, rows: Callable, schema: str, flush: int = 20_000) -> DataFrame:
    """mapInArrow over a generator of row tuples; ``rows`` gets the batches of a task."""
    # The Arrow schema is made on the driver and travels with the function.
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        try:
            for row in rows(batches):
                held.append(row)
                if len(held) >= flush:
                    yield _batch(held, arrow)
                    held = []
            if held:
                yield _batch(held, arrow)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def _batch(held: list, arrow: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, type=f.type) for c, f in zip(zip(*held), arrow)]
    return pa.RecordBatch.from_arrays(columns, schema=arrow)


def give_back() -> None:
    """Return freed memory to the system; a worker lives on after its task, beside the JVM and the other workers."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def lean(function: Callable, *given):
    """The function's result for what is given, after which freed memory goes back."""
    try:
        return function(*given)
    finally:
        give_back()


def kept_by_worker(name: str, make: Callable):
    """An object that lives as long as the Python worker, across its tasks.

    Functions travel by value, so their module globals are new in every task.
    """
    holder = sys.modules.setdefault("_tradeloom_worker", types.ModuleType("_tradeloom_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)
