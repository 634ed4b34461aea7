"""Exact deduplication as a stateful stream.

The digests of all texts are streamed through keyed state on disk (RocksDB)
that never expires: a running aggregate whose state is read when the stream has
taken all rows. A key's state holds the digest, the id of the document
that stays, a content locator (the file) and the number of rows. Every hit's full text is then read
at its locator and checked against that of the document that stays; rows that share a digest but
not the text are grouped by the text itself.

Texts are equal when identical after lower-casing A-Z. The row with the largest
doc_id stays; a null id is below all others, and of rows that repeat an id the
one read last stays. A null text counts as empty. An empty table gives an empty
result. Other columns, whatever their names, are not looked at.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import scratch_path, settle
from tradeloom.llm.text import fresh, lower_ascii, quoted, whole

NO_ID = -(2**63)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SEEN = "digest string, ranked long, row long, locator string, n_bytes long"
#: Rows of one group that are compared with one copy of its text.
ROWS_PER_COPY = 1000


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def stream_groups(seen_path: str, spark, files_per_batch: int = 1000) -> DataFrame:
    """One row per digest from the stream over ``seen_path``: who stays, and how many rows.

    The running aggregate is the keyed state; it is read from its last checkpoint.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Many small state stores: without this each sets aside 4 MB of disk.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    state = scratch_path(spark, "dedup-state")
    best = F.max(F.struct("ranked", "row", "locator", "n_bytes")).alias("best")
    (
        own.readStream.schema(SEEN)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(seen_path)
        .groupBy("digest")
        .agg(best, F.count(F.lit(1)).alias("group_size"))
        .writeStream.format("noop")
        .option("checkpointLocation", state)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    kept = spark.read.format("statestore").option("path", state).load()
    return kept.select("key.digest", F.col("value.count").alias("group_size"), "value.max.*")


def decide(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 1000) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, locator."""
    spark = docs.sparkSession
    plain = lower_ascii(F.col("text"))
    seen = whole(docs).select(
        digest(plain).alias("digest"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("ranked"),
        F.monotonically_increasing_id().alias("row"),
        F.input_file_name().alias("locator"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    path = scratch_path(spark, "dedup-seen")
    seen.write.parquet(path)
    seen = spark.read.schema(SEEN).parquet(path)
    groups = settle(stream_groups(path, spark, files_per_batch), "dedup-groups")
    one = groups.select(
        "digest", F.col("ranked").alias("keep"), F.col("row").alias("keep_row"),
        F.col("locator").alias("content_locator"), "group_size",
    )
    found = seen.join(one, "digest").select(*one.columns, "ranked", "row", "locator")
    hits = settle(_hits(docs, found, digest), "dedup-hits")
    odd = _unequal(hits, one).withColumnRenamed("digest", "odd_digest")
    apart = _by_text(hits.join(odd, F.col("digest") == F.col("odd_digest"), "left_semi"))
    alone = found.join(odd, F.col("digest") == F.col("odd_digest"), "left_anti").select(
        "ranked", "keep", "group_size", (F.col("keep_row") == F.col("row")).alias("kept"), "digest", "content_locator"
    )
    return alone.unionByName(apart).select(
        _id(F.col("ranked")).alias("doc_id"), _id(F.col("keep")).alias("keep_id"), "group_size", "kept", "digest", "content_locator"
    )


def _by_text(rows: DataFrame) -> DataFrame:
    """Groups by the text itself, for rows that only share a digest."""
    best = rows.groupBy("digest", "plain").agg(
        F.max(F.struct("ranked", "row", "locator")).alias("b"), F.count(F.lit(1)).alias("group_size")
    )
    return rows.select("ranked", "row", "digest", "plain").join(best, ["digest", "plain"]).select(
        "ranked", F.col("b.ranked").alias("keep"), "group_size", (F.col("b.row") == F.col("row")).alias("kept"), "digest",
        F.col("b.locator").alias("content_locator"),
    )


def _id(ranked: Column) -> Column:
    return F.when(ranked != NO_ID, ranked)


def _hits(docs: DataFrame, found: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Full texts of the rows whose digest was seen more than once, read at their locators.

    Each (locator, id, digest) asks once, so that any number of equal rows, with or
    without an id, are that many rows.
    """
    asked = found.filter("group_size > 1").select(
        F.xxhash64("locator").alias("place"), "ranked", "digest", "group_size", (F.col("ranked") == F.col("keep")).alias("stays")
    ).distinct()
    body = whole(docs).select(
        F.xxhash64(F.input_file_name()).alias("place"),
        F.input_file_name().alias("locator"),
        F.coalesce("doc_id", F.lit(NO_ID)).alias("ranked"),
        F.monotonically_increasing_id().alias("row"),
        lower_ascii(F.col("text")).alias("plain"),
    )
    return body.withColumn("digest", digest(F.col("plain"))).join(asked, ["place", "ranked", "digest"]).drop("place")


def _unequal(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests under which a text differs from that of a row that stays.

    A group's kept text is copied once per ROWS_PER_COPY rows, so that a huge
    group is compared in many tasks.
    """
    copies = F.ceil(F.col("group_size") / ROWS_PER_COPY).cast("int")
    members = hits.select("digest", "plain", F.pmod("row", copies).cast("int").alias("copy"))
    stays = hits.filter("stays").groupBy("digest").agg(F.max("plain").alias("kept_plain"), F.first("group_size").alias("group_size"))
    stays = stays.select("digest", "kept_plain", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    unequal = members.join(stays, ["digest", "copy"]).filter("plain != kept_plain")
    return settle(unequal.select("digest").distinct(), "dedup-unequal")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    ranked, hashed = fresh(docs, "ranked"), fresh(docs, "digest")
    stay = decide(docs, **options).filter("kept").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias(ranked), F.col("digest").alias(hashed)
    )
    digest = options.get("digest", sha256)
    marked = docs.select(
        "*",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(ranked),
        digest(lower_ascii(F.coalesce("text", F.lit("")))).alias(hashed),
    )
    both = marked.join(stay.distinct(), [ranked, hashed], "left_semi")
    return both.dropDuplicates([ranked, hashed]).select(*quoted(docs))
