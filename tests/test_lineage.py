import json
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradeloom.operators import lineage
from tradeloom.plans.observability import emitted_edges, step_edges
from pyspark.sql import functions as F


def graph(spark, *pairs, batch="b1"):
    data = [(batch, s, t, f"t{i}", "stage", i, "{}") for i, (s, t) in enumerate(pairs)]
    schema = "batch_id string, source string, target string, transform string, stage string, ts int, metadata string"
    return spark.createDataFrame(data, schema)


def names(df):
    return [r.node for r in df.collect()]


@pytest.fixture(scope="module")
def chain(spark):
    return graph(
        spark, ("raw.notional", "enriched.notional_usd"), ("enriched.notional_usd", "risk_report.usd_exposure")
    )


def test_ancestors_come_farthest_first(chain):
    assert names(lineage.ancestors(chain, "risk_report.usd_exposure")) == ["raw.notional", "enriched.notional_usd"]
    assert names(lineage.descendants(chain, "raw.notional")) == ["enriched.notional_usd", "risk_report.usd_exposure"]
    assert names(lineage.ancestors(chain, "unknown.x")) == []


def test_cycles_end_and_diamonds_count_once(spark):
    edges = graph(spark, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"))
    assert sorted(names(lineage.descendants(edges, "a"))) == ["b", "c", "d", "e"]
    path = lineage.shortest_path(edges, "a", "e").orderBy("position")
    assert names(path) == ["a", "b", "d", "e"]
    assert names(lineage.shortest_path(edges, "e", "a")) == []
    assert names(lineage.shortest_path(edges, "a", "nowhere")) == []
    assert names(lineage.shortest_path(edges, "a", "a")) == ["a"]
    assert names(lineage.shortest_path(edges, "zz", "zz")) == []


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=st.lists(st.tuples(st.sampled_from("abcdefghi"), st.sampled_from("abcdefghi")), min_size=6, max_size=22))
def test_paths_against_plain_search(spark, pairs):
    found = {"a": ["a"]}
    frontier = [["a"]]
    while frontier:
        longer = sorted(p + [t] for p in frontier for s, t in set(pairs) if s == p[-1] and t not in found)
        frontier = [p for k, p in enumerate(longer) if p[-1] not in {q[-1] for q in longer[:k]}]
        found.update({p[-1]: p for p in frontier})
    path = lineage.shortest_path(graph(spark, *pairs), "a", "i", buckets=3).orderBy("position")
    assert names(path) == found.get("i", [])


def test_both_frontiers_go_half_way(spark, monkeypatch):
    grown = []
    grow = lineage._Frontiers.grow
    monkeypatch.setattr(lineage._Frontiers, "grow", lambda self: (grown.append(self.near), grow(self))[1])
    edges = graph(spark, *[(f"n{k}", f"n{k + 1}") for k in range(7)])
    assert names(lineage.shortest_path(edges, "n0", "n7").orderBy("position")) == [f"n{k}" for k in range(8)]
    assert len(grown) == 7 and abs(grown.count("source") - grown.count("target")) <= 1


def test_frontier_reads_its_buckets_only(spark):
    links = lineage.Links(graph(spark, *[(f"n{k}", f"n{k + 1}") for k in range(40)]), buckets=16)
    one = spark.createDataFrame([("n3",), ("zz",)], "node string")
    found = links.from_(one, "source")
    assert rows(found, "near", "far") == [("n3", "n4")]
    filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    assert "bucket" in filters.split("PushedFilters")[0] and "side" in filters.split("PushedFilters")[0]
    assert rows(links.from_(one, "target"), "far") == [("n2",)]


def test_graph_is_folded_in_any_order(spark, tmp_path):
    log = [graph(spark, ("a", "b"), ("b", "c"), batch="b1"), graph(spark, ("x", "y"), ("a", "b"), ("a", "b"), batch="b2"), graph(spark, ("c", "d"), batch="b3")]
    want = rows(lineage.collapse(lineage.merge(*log)), *sorted(["source", "target", *lineage.EDGE_ATTRIBUTES]))
    for order in ((0, 1, 2), (2, 1, 0, 1)):
        store = lineage.GraphStore(spark, str(tmp_path / "".join(map(str, order))), buckets=4)
        assert store.edges() is None and store.fold(log[0].limit(0)) == []
        for k in order:
            assert 0 < len(store.fold(log[k])) <= 4
        assert rows(store.edges(), *sorted(["source", "target", *lineage.EDGE_ATTRIBUTES])) == want


def test_fold_that_dies_stays_invisible(spark, tmp_path, monkeypatch):
    store = lineage.GraphStore(spark, str(tmp_path / "g"), buckets=4)
    store.fold(graph(spark, ("a", "b")))
    before = rows(store.edges())
    monkeypatch.setattr(type(before and store.edges()), "coalesce", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.fold(graph(spark, ("a", "b"), ("a", "b"), ("c", "d")))
    monkeypatch.undo()
    assert rows(store.edges()) == before
    store.fold(graph(spark, ("c", "d")))
    assert rows(store.edges(), "source", "transform") == [("a", "t0"), ("c", "t0")]


def test_collapse_keeps_the_last_edge(spark):
    edges = graph(spark, ("a", "b"), ("a", "b"), ("b", "c"))
    assert rows(lineage.collapse(edges), "source", "target", "transform") == [("a", "b", "t1"), ("b", "c", "t2")]
    assert rows(lineage.transforms_touching(edges, "a")) == [("t0",), ("t1",)]
    assert rows(lineage.transforms_touching(lineage.collapse(edges), "a")) == [("t1",)]
    assert rows(lineage.direct(edges, "b"), "role", "node", "transform") == [
        ("source", "a", "t0"), ("source", "a", "t1"), ("target", "c", "t2"),
    ]


def test_impact_includes_producers_of_the_source(chain):
    found = rows(lineage.impact(chain, "enriched.notional_usd"))
    assert found == [("descendant", "risk_report.usd_exposure"), ("transform", "t0"), ("transform", "t1")]


def test_layers_and_summary(spark):
    edges = lineage.merge(
        graph(spark, ("raw.a", "clean.a"), ("odd", "legacy.x")), graph(spark, ("raw.a", "clean.a"), batch="b2")
    )
    assert rows(lineage.nodes_by_layer(edges)) == [
        (1, "raw", "raw.a"), (2, "clean", "clean.a"), (8, "other", "legacy.x"), (8, "other", "odd"),
    ]
    assert tuple(lineage.summary(edges).first()) == (4, 2, 2, 2, 2)
    assert ("batch", "b2") in rows(lineage.summary_members(edges))
    assert lineage.for_batch(edges, "b2").count() == 1


def test_exports(spark, tmp_path):
    edges = graph(spark, ("raw.a b/c", 'clean."q"\\'), ("plain", "raw.a.b"))
    assert ("plain", "unknown", "plain") in rows(lineage.export_nodes(edges))
    assert ("raw.a.b", "raw", "b") in rows(lineage.export_nodes(edges))
    assert ("plain", "plain", "other", "#9CA3AF") in rows(lineage.cytoscape_nodes(edges))
    text = [r.triple for r in lineage.triples(edges).collect()]
    assert len(text) == 2 * 6 + 4 * 2
    assert any("/column/raw.a_b_c>" in t for t in text) and any('"\\"q\\"\\\\" .' in t for t in text)
    lineage.write_json(edges, str(tmp_path / "g"))
    assert lineage.read_json(spark, str(tmp_path / "g")).count() == 2
    lineage.write_triples(edges, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 20


def test_parts_make_one_json_document(spark, tmp_path):
    edges = graph(spark, *[(f"raw.c{k}", f"clean.c{k % 7}") for k in range(60)], ('raw."q"', "clean.é"))
    path = tmp_path / "document"
    lineage.write_json_document(edges, str(path))
    parts = sorted(path.glob("part-*"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert [n["id"] for n in document["nodes"]] == sorted(r.id for r in lineage.export_nodes(edges).collect())
    assert {(e["source"], e["target"], e["transform"]) for e in document["edges"]} == set(rows(lineage.collapse(edges), "source", "target", "transform"))
    assert document["edges"][0]["metadata"] == {}
    whole = tmp_path / "whole.json"
    whole.write_text(json.dumps(document))
    assert rows(lineage.read_json_document(spark, str(whole))) == rows(lineage.export_edges(edges).select("source", "target", "transform", "stage", "batch_id", "metadata"))
    lineage.write_json_document(graph(spark), str(tmp_path / "none"))
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "none").glob("part-*")))) == {"nodes": [], "edges": []}


def test_json_document_gets_defaults(spark, tmp_path):
    path = tmp_path / "graph.json"
    path.write_text(json.dumps({"nodes": [], "edges": [
        {"source": "a", "target": "b"},
        {"source": "b", "target": "c", "transform": "t", "metadata": {"k": 1}},
    ]}, indent=2))
    found = lineage.read_json_document(spark, str(path))
    assert rows(found) == [
        ("a", "b", "unknown", "unknown", "unknown", "{}"), ("b", "c", "t", "unknown", "unknown", '{"k":1}'),
    ]


def test_edges_follow_columns_and_options():
    edges = step_edges({"trade_id", "notional", "currency", "amount"}, {"fx_convert": {"source_col": "amount"}})
    assert ("clean.amount", "enriched.notional_usd", "fx_convert", "enrich") in edges
    assert {s for s, _, t, _ in edges if t == "type_cast"} == {"raw.trade_id", "raw.notional", "raw.currency"}
    assert not any(t in ("date_expand", "lei_lookup", "position_net", "exposure_rollup") for _, _, t, _ in edges)
    renamed = step_edges({"trade_id", "day", "party", "size"}, {
        "type_cast": {"size": "double"}, "dedup": {"key_cols": ["trade_id", "day"]}, "date_expand": {"date_col": "day"}, "lei_lookup": {"counterparty_col": "party"},
    })
    assert {s for s, _, t, _ in renamed if t == "type_cast"} == {"raw.trade_id", "raw.size"}
    assert {s for s, _, t, _ in renamed if t == "dedup"} == {"typed.trade_id", "typed.day"}
    assert {s for s, _, t, _ in renamed if t == "date_expand"} == {"clean.day"} and {s for s, _, t, _ in renamed if t == "lei_lookup"} == {"clean.party"}


def test_emitted_edges(spark):
    assert len(step_edges()) == 29
    counts = spark.createDataFrame(
        [("b1", "notional", 2, "0.0"), ("b1", "currency", 0, "USD")],
        "batch_id string, column_name string, null_count bigint, fill_value string",
    )
    edges = emitted_edges(counts, F.lit(1))
    assert edges.count() == 30
    assert edges.where("transform = 'null_fill'").first().target == "clean.notional"


def test_states_are_shuffled_once_by_a_fold(spark, tmp_path):
    store = lineage.GraphStore(spark, str(tmp_path / "graph"))
    columns = "bucket int, source string, target string, ts timestamp, transform string, stage string, batch_id string, metadata string"
    old, new = (spark.createDataFrame([(1, "a", "b", datetime(2026, 1, day), name, "s", "b", "{}")], columns) for day, name in ((1, "x"), (2, "y")))
    for rows_, before in ((new, None), (new, old), (old, new)):
        out = store._updated(rows_, before)
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert [r.transform for r in out.collect()] == ["y"]
