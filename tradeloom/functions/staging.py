"""Small written tables between steps of one job.

``settle`` writes a DataFrame to the shared folder and reads it back. That cuts
the lineage, survives lost executors, and gives the optimizer the real size of
the table: a join with it is broadcast only when its files are below
``spark.sql.autoBroadcastJoinThreshold`` and is shuffled (with adaptive skew
handling) otherwise.
"""

import gc
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


_MADE: ContextVar[list | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, or else below the warehouse.

    Both are folders that all executors share. Nothing in it is needed once the
    application has ended; ``remove_scratch`` deletes it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def _in_store(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, whatever store it is in, and the path for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _in_store(spark, path)
    return store.exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    store, place = _in_store(spark, path)
    store.delete(place, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediate tables."""
    delete_folder(spark, shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The scratch paths that are given out meanwhile."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)


def free(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete scratch tables that are not needed any more, and shuffle files of jobs whose DataFrames are gone.

    Spark deletes a shuffle's files when the driver's collectors find its DataFrame unused.
    """
    for path in paths:
        delete_folder(spark, path)
    gc.collect()
    spark._jvm.System.gc()


#: For each session: how many have asked for dropped shuffles and not left yet, and the setting before the first.
_DROPPING: dict[int, tuple[int, str]] = {}
_LOCK = Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run meanwhile are deleted as each job ends.

    For jobs whose results are written. The setting is the session's and stays until the last of
    several users at a time has left; jobs side by side that see it each lose their own files only.
    """
    name, key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", id(spark)
    with _LOCK:
        users, before = _DROPPING.get(key) or (0, spark.conf.get(name))
        _DROPPING[key] = users + 1, before
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _LOCK:
            users, before = _DROPPING.pop(key)
            if users > 1:
                _DROPPING[key] = users - 1, before
            else:
                spark.conf.set(name, before)


@contextmanager
def open_folders(spark: SparkSession, folders: int) -> Iterator[None]:
    """Writes begun meanwhile keep up to ``folders`` folders open in a task, instead of sorting its rows by them.

    For a few folders and no bucketed tables; a task that meets more folders sorts the rest. The
    setting is the session's: jobs side by side may see it, which changes none of their rows.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, name: str = "settled", partition: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def watched(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with its row count (``rows``) and further aggregates gathered by the job that writes it.

    The metrics belong to the last stage of that job, where only the first success of
    each task counts, so a repeated task does not change them.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), seen


def settle_counted(
    df: DataFrame, name: str = "settled", partition: Sequence[str] = (), **metrics: Column
) -> tuple[DataFrame, dict]:
    """``settle``, and the metrics of ``watched``."""
    seen_rows, seen = watched(df, **metrics)
    return settle(seen_rows, name, partition), seen.get


def at_once(*jobs: Callable) -> list:
    """Run independent Spark jobs side by side and return their results in order.

    The jobs must write to different folders: the first to commit would remove
    the other's unfinished files.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, job) for job in jobs]]


def settle_all(**tables: DataFrame) -> list[DataFrame]:
    """Settle several tables side by side."""
    return at_once(*[lambda n=name, t=df: settle(t, n) for name, df in tables.items()])
