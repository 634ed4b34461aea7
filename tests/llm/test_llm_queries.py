"""The registered queries: SQL on the given tables, and the pipeline against plain stages."""

import subprocess
import sys

import cases
import compare
import pyarrow as pa
import pytest
from conftest import ROOT
from pyspark.sql import functions as F

import corpus_pipeline
from test_dedup import plain_near, plain_suffix
from tradeloom.llm import quality, queries, suffix

FOLDER = "/root/testdata/sf0.001"
#: Table and key of queries that read no documents.
OTHER = {"op11_conversation_repair": ("conversations", "conv_id"), "op12_embedding_whitening": ("embeddings", "vec_id")}


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_matches_sql(spark, name):
    con = compare.connect(FOLDER)
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), con, queries.ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_covers_its_table(spark, name):
    table, key = OTHER.get(name, ("documents", "doc_id"))
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    found = queries.QUERIES[name](spark, FOLDER)
    assert found.select(key).distinct().count() == rows.select(key).distinct().count()


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.select("doc_id", "text").collect() if "text" in docs.columns else None
        if name != "packing":
            assert docs.columns == columns
        kept[name] = before, after
    before, after = kept["quality_classifier"]
    assert 0 < len(after) < len(before)
    before, after = kept["exact_dedup"]
    assert {r.doc_id for r in after} == {max(d for d, t in before if t.lower() == x) for x in {t.lower() for _, t in before}}
    before, after = kept["near_dedup"]
    assert {r.doc_id for r in after} == {d for d, _, _, k in plain_near(before) if k}
    before, after = kept["suffix_array_dedup"]
    assert len(after) == len(before)
    want = {r[0]: r[1] - r[2] for r in plain_suffix(before)}
    assert all(abs(len(r.text.encode()) - want[r.doc_id]) <= 6 for r in after)
    before, _ = kept["packing"]
    assert docs.select("doc_id").distinct().count() == len(before)
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_pipeline_runs_on_odd_rows(spark, tmp_path):
    cases.docs(spark, cases.odd_rows()).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert quality and suffix


def test_stages_send_texts_in_small_batches(spark):
    """32 MB of texts of one task reach its Python worker in batches of a few MB, also after the stage returned."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    @corpus_pipeline.stage
    def measured(spark, docs, folder):
        return docs.mapInArrow(sizes, "size long")

    try:
        docs = spark.range(64, numPartitions=1).select(F.repeat(F.lit("x"), F.lit(500_000)).alias("text"))
        found = [r.size for r in measured(spark, docs, "").collect()]
    finally:
        spark.conf.set(setting, before)
    assert sum(found) >= 32_000_000 and max(found) < 8_000_000


def test_workers_give_freed_memory_back():
    """What a task freed does not stay with its worker, whose arenas keep it otherwise."""
    code = """
import re
from tradeloom.llm.text import lean
def held():
    return sum(map(int, re.findall(r"Private_Dirty:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
def work():
    many = [bytes(2000) for _ in range(100_000)]
    work.kept = many[::50]
    work.kept.append(many[-1])
    del many
lean(len, "")
first = held()
lean(work)
assert held() - first < 60, (first, held())
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
