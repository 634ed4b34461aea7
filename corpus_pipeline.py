"""The corpus pipeline: from raw documents to packed sequences.

Each stage's result is written before the next one begins; what a stage settled on its
way is deleted then. Stages set the session's bytes of an Arrow batch to BATCH.
"""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeloom.functions.staging import free, scratch_path, tracked
from tradeloom.llm import exact, minhash, packing, quality, suffix
from tradeloom.llm.text import table


#: Texts that travel to a Python worker at once: the executor and the worker each hold them, in buffers that double.
BATCH = "4m"
#: Scratch tables of the stage that ran last, by application.
_settled: dict[str, list[str]] = {}


def stage(function: Callable) -> Callable:
    """A stage that first frees what the one before it left behind."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        free(spark, _settled.pop(application, []))
        # for the jobs that the caller runs over the result as well
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
        with tracked() as made:
            out = function(spark, docs, folder)
        _settled[application] = made
        return out

    return run_stage


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, folder, "labels"))


@stage
def exact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group with equal texts."""
    return exact.deduplicate(docs)


@stage
def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicate(docs)


@stage
def passage_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without passages that a document with a smaller id has."""
    return suffix.deduplicate(docs)


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("suffix_array_dedup", passage_stage),
    ("packing", packing_stage),
]

#: The classifier, hashing and packing cannot be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order; each writes Parquet that the next one reads."""
    docs = table(spark, folder)
    for name, function in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        function(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
