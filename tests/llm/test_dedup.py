"""Exact, near and passage deduplication against brute force."""

import hashlib
import random

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.llm import exact, minhash, suffix
from tradeloom.llm.components import components


def lower(text):
    return (text or "").encode().lower().decode()


def rank(doc_id):
    return -(2**63) if doc_id is None else doc_id


def plain_exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(lower(text), []).append(doc_id)
    return sorted(
        ((d, max(groups[lower(t)], key=rank), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for d, t in rows), key=repr
    )


@pytest.mark.parametrize("files", [1, 1000])
def test_exact_of_odd_rows(spark, files):
    rows = cases.odd_rows()
    table = cases.docs(spark, rows).repartition(5)
    found = exact.decide(table, files_per_batch=files)
    assert cases.pairs(found, "doc_id", "keep_id", "group_size", "digest") == plain_exact(rows)
    assert found.filter("kept").count() == len({lower(t) for _, t in rows})
    left = exact.deduplicate(table)
    assert left.columns == table.columns
    assert sorted(lower(r.text) for r in left.collect()) == sorted({lower(t) for _, t in rows})


def test_exact_checks_the_bytes_behind_a_digest(spark):
    rows = [(k, f"text {k % 5}") for k in range(40)] + [(50, None), (51, "")]
    weak = lambda text: (F.octet_length(text) % 2).cast("string")
    found = exact.decide(cases.docs(spark, rows), digest=weak)
    want = [(d, k, n) for d, k, n, _ in plain_exact(rows)]
    assert cases.pairs(found, "doc_id", "keep_id", "group_size") == sorted(want, key=repr)
    assert found.filter("kept").count() == 6


def test_many_equal_rows_without_id(spark, tmp_path):
    """Work follows the rows, not their square."""
    rows = spark.range(100_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") % 100 > 0, F.lit("the Same")).otherwise(F.lit("other")).alias("text")
    )
    rows.repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = exact.decide(docs).groupBy("group_size").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept"))
    assert cases.pairs(found, "group_size", "n", "kept") == [(1000, 1000, 1), (99000, 99000, 1)]
    assert exact.deduplicate(docs).count() == 2


def test_exact_of_an_empty_table(spark):
    none = cases.docs(spark, [])
    assert exact.decide(none).count() == 0
    assert exact.deduplicate(none).count() == 0


def near_rows():
    """A hub with edited copies, copies of copies, exact copies, short texts and unrelated texts."""
    rng, rows = random.Random(5), []
    base = cases.words(7, 200)
    for k in range(60):
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = f"w{rng.randrange(10**6)}"
        rows.append((1000 - k, " ".join(text)))
    chain = list(base)
    for k in range(12):
        chain[rng.randrange(len(chain))] = f"c{k}"
        rows.append((2000 + k, " ".join(chain)))
    rows += [(3000 + k, " ".join(cases.words(100 + k, 90))) for k in range(30)]
    rows += [(4000 + k, rows[k][1].upper()) for k in range(5)]
    return rows + cases.odd_rows()


def plain_near(rows, percent=75):
    def shingle_set(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [(rank(d), shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    back = lambda d: None if d == -(2**63) else d
    return sorted(((back(d), len(s), back(find(d)), find(d) == d) for d, s in sets), key=repr)


def test_near_duplicates_against_all_pairs(spark):
    rows = near_rows()
    found = minhash.near_duplicates(cases.docs(spark, rows).repartition(4))
    assert cases.pairs(found, "doc_id", "n_shingles", "component_id", "kept") == plain_near(rows)


def test_blocks_of_a_large_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = near_rows()
    found = minhash.near_duplicates(cases.docs(spark, rows))
    assert cases.pairs(found, "doc_id", "n_shingles", "component_id", "kept") == plain_near(rows)


def test_near_duplicates_of_ids_with_several_texts(spark):
    a, b, c = (cases.words(k, 60) for k in (501, 502, 503))
    rows = [(20, " ".join(t)) for t in (a, b, c)] + [(30 + k, " ".join([*t, "more"])) for k, t in enumerate((a, b, c))]
    found = minhash.near_duplicates(cases.docs(spark, rows))
    assert cases.pairs(found, "doc_id", "component_id", "kept") == [(20, 20, True)] * 3 + [(30 + k, 20, False) for k in range(3)]


def test_near_dedup_keeps_one_of_each(spark):
    rows = near_rows()
    table = cases.docs(spark, rows)
    left = minhash.deduplicate(table)
    assert left.columns == table.columns
    assert {r.doc_id for r in left.collect()} == {d for d, _, _, kept in plain_near(rows) if kept}
    assert minhash.near_duplicates(cases.docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=60))
def test_signature_estimates_similarity(words):
    text = " ".join(f"w{k}" for k in words).encode()
    found = minhash.shingles(text, minhash._Hashes())
    assert len(found) == len({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}) if words else len(found) == 0
    if len(found):
        values = minhash.signature(found).reshape(-1, 2)
        assert (values[:, 0] <= values[:, 1]).all()


def test_min_and_max_both_estimate(spark):
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = x[:2400], x[600:]  # similarity 0.6
    same = (minhash.signature(np.sort(a)) == minhash.signature(np.sort(b))).reshape(-1, 2).mean(0)
    assert abs(same[0] - 0.6) < 0.2 and abs(same[1] - 0.6) < 0.2


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (7, 7)] + [(500, 600 + k) for k in range(30)]
    found = components(spark.createDataFrame(edges, "u long, v long"))
    want = [(k, 0) for k in range(41)] + [(k, 90) for k in (90, 95, 100)] + [(500, 500)] + [(600 + k, 500) for k in range(30)]
    assert cases.pairs(found, "node", "component") == sorted(want, key=repr)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_suffix(rows):
    least = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            least[w] = min(least.get(w, 2**63), rank(doc_id))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if least[b[p : p + 50]] < rank(doc_id):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passage_rows():
    rng = random.Random(9)
    passages = [" ".join(cases.words(50 + k, 25)) for k in range(4)]
    rows = []
    for k in range(40):
        parts = [" ".join(cases.words(200 + k, rng.randint(3, 40)))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [p[cut : cut + rng.randint(40, 120)], " ".join(cases.words(300 + rng.randrange(99), rng.randint(0, 9)))]
        rows.append((rng.randrange(10**6), "".join(parts)))
    rows += [(10**7 + k, "the same boilerplate line that opens many of these documents here\n" + " ".join(cases.words(k, 9))) for k in range(30)]
    rows += [(5, "ab" * 300), (6, "ab" * 200 + "c" + "ab" * 90), (2 * 10**7, "ab" * 250), (3, "é" * 100), (4, "x" + "é" * 90)]
    return rows


def test_passages_against_all_windows(spark):
    rows = passage_rows() + [r for r in cases.odd_rows() if len(r[1] or "") < 10_000]
    found = suffix.remove_repeats(cases.docs(spark, rows).repartition(4))
    assert cases.pairs(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain_suffix(rows)


def test_passages_of_rows_without_id_or_with_one_id(spark):
    """Rows of one id do not cover each other, and none loses its removal to another."""
    passage = " ".join(cases.words(77, 16))[:90]
    rows = [(k, f"{passage} {k} {' '.join(cases.words(k, 3))}") for k in range(700)]
    rows += [(None, f"{passage} {k} {' '.join(cases.words(5000 + k, 3))}") for k in range(700)]
    rows += [(900, f"{k} {passage} x{k} {passage[:60]}") for k in range(500)] + [(901, f"q{k} {passage[20:80]}") for k in range(60)]
    rows += [(902, rows[0][1])] * 5 + [(None, rows[0][1])] * 5
    found = suffix.remove_repeats(cases.docs(spark, rows).repartition(6))
    assert cases.pairs(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain_suffix(rows)
    left = suffix.deduplicate(cases.docs(spark, rows))
    assert left.count() == len(rows) and left.filter(F.col("doc_id").isNull() & F.col("text").contains(passage)).count() == 705


@settings(max_examples=80, deadline=None)
@given(
    people=st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1) | st.integers(0, 300), st.integers(-(2**63), 2**63 - 1)), min_size=1, max_size=9, unique=True),
    data=st.data(),
)
def test_packed_rows_come_back(people, data):
    who = np.array(people, suffix.WHO)
    owner = np.array(data.draw(st.lists(st.integers(0, len(people) - 1), max_size=300)), np.int64)
    rows = np.array([(k, k + 1) for k in range(len(owner))], suffix.SPAN)
    names, back, found = suffix.documents_of([suffix.by_document(who, owner, rows)] * 2, suffix.SPAN)
    have = sorted((*names[o].tolist(), r["lo"]) for o, r in zip(back, found))
    assert have == sorted((*people[o], k) for k, o in enumerate(owner.tolist()) for _ in range(2))


@settings(max_examples=80, deadline=None)
@given(spans=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 60), st.integers(1, 12)), max_size=40))
def test_spans_become_maximal(spans):
    owner = np.array([s[0] for s in spans], np.int64)
    owner, out = suffix.maximal(owner, np.array([s[1:] for s in spans], suffix.SPAN))
    have = {(o, p) for o, lo, size in zip(owner.tolist(), out["lo"].tolist(), out["size"].tolist()) for p in range(lo, lo + size)}
    assert have == {(o, p) for o, lo, size in spans for p in range(lo, lo + size)}
    pieces = list(zip(owner.tolist(), out["lo"].tolist(), (out["lo"] + out["size"]).tolist()))
    assert pieces == sorted(pieces) and all(a[0] != b[0] or a[2] < b[1] for a, b in zip(pieces, pieces[1:]))


def test_pieces_of_a_long_text_lose_no_window(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 64)
    monkeypatch.setattr(suffix, "RUNS_PER_BLOB", 20)
    rows = passage_rows()
    found = suffix.remove_repeats(cases.docs(spark, rows), buckets=3)
    assert cases.pairs(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == plain_suffix(rows)


def test_passages_are_taken_out_of_the_table(spark):
    rows = passage_rows() + [(None, None), (9, None)]
    table = cases.docs(spark, rows)
    left = suffix.deduplicate(table)
    assert left.columns == table.columns and left.count() == len(rows)
    spans = {r.doc_id: r.spans for r in suffix.remove_repeats(table).collect()}
    text = {d: t for d, t in rows}
    for r in left.collect():
        if text[r.doc_id] is None:
            assert r.text is None
        else:
            b = text[r.doc_id].encode()
            assert r.text == suffix.cut(b, [tuple(s) for s in spans[r.doc_id]]).decode("utf-8", "ignore")
    assert suffix.remove_repeats(cases.docs(spark, [])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=70), min_size=1, max_size=40))
def test_suffix_sort(contents):
    tool = suffix.Suffixes(contents, np.zeros(len(contents), np.int64), 0)
    order = tool.sort(np.zeros(len(contents), np.int64))
    assert [contents[k] for k in order] == sorted(contents)
    common = tool.common(order[1:], order[:-1])
    for a, b, n in zip(order[1:], order[:-1], common):
        x, y = contents[a], contents[b]
        want = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert n == want


def test_a_hash_collision_is_seen_and_repaired(monkeypatch):
    rows = {"h": np.array([1, 1]), "doc": np.array([1, 2]), "da": np.array([0, 0]), "dh": np.array([0, 0])}
    rows["content"] = [bytes(range(50)), bytes(range(1, 51))]
    sums = suffix.Prefix.sums
    monkeypatch.setattr(suffix.Prefix, "sums", lambda self, data: sums(self, data) * np.uint64(0))
    assert suffix.equal_windows(rows) is None
    monkeypatch.undo()
    assert not suffix.equal_windows(rows).any()
