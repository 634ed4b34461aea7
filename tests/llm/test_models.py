"""Language identification, repetition rules, language-model scores and the quality classifier."""

import math
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle
from tradeloom.llm import langid, lm, quality, repetition
from tradeloom.llm.text import remainder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return langid.Vocabulary(PIECES)


def plain_word_score(word, vocabulary, prob):
    number = {p: k for k, p in enumerate(vocabulary.pieces)}
    word = "▁" + word
    total = [1.0] + [0.0] * len(word)
    for e in range(1, len(word) + 1):
        for size in range(1, min(langid.LONGEST, e) + 1):
            k = number.get(word[e - size : e])
            p = prob[k] if k is not None else 0.0
            total[e] += total[e - size] * (max(p, langid.FLOOR) if size == 1 else p)
    return math.log(total[-1])


@settings(max_examples=60, deadline=None)
@given(words=st.lists(st.text(alphabet="theandofüßé日!x", min_size=1, max_size=45), min_size=1, max_size=8))
def test_forward_sums_all_segmentations(vocabulary, words):
    rng = np.random.default_rng(1)
    prob = rng.random((len(vocabulary.pieces), 2))
    prob /= prob.sum(0)
    found = langid.word_scores(words, vocabulary, prob)
    for k in (0, 1):
        want = [plain_word_score(w, vocabulary, prob[:, k]) for w in words]
        assert np.allclose(found[:, k], want)


def test_every_piece_is_found_and_nothing_else(vocabulary):
    some = vocabulary.pieces[::997]
    hashes = np.array([vocabulary._hash(p) for p in some + ["zzqqxxj", "☃☃☃"]], np.uint64)
    assert vocabulary.find(hashes).tolist() == [*range(0, len(vocabulary.pieces), 997), -1, -1]


def test_expected_uses_sum_to_the_words(vocabulary):
    prob = np.full((len(vocabulary.pieces), 1), 1 / len(vocabulary.pieces))
    uses = langid.expected(["the", "of"], np.array([[3.0], [2.0]]), vocabulary, prob)
    length = np.array([len(p) for p in vocabulary.pieces])
    assert abs((uses[:, 0] * length).sum() - (3 * 4 + 2 * 3)) < 1e-6  # characters with the mark


def test_pieces_and_words_of_every_length_are_used(spark, vocabulary):
    assert max(map(len, vocabulary.pieces)) > 8
    piece = max((p for p in vocabulary.pieces if p[0] == "▁" and p[1:].isalpha()), key=len)
    uniform = np.full((len(vocabulary.pieces), 1), 1 / len(vocabulary.pieces))
    uses = langid.expected([piece[1:]], np.array([[1.0]]), vocabulary, uniform)
    assert uses[vocabulary.pieces.index(piece), 0] > 0.99
    long = langid.expected(["the" * 200], np.array([[5.0]]), vocabulary, uniform)
    length = np.array([len(p) for p in vocabulary.pieces])
    assert (long[:, 0] * length).sum() == pytest.approx(5 * 601)
    counted = spark.createDataFrame([("en", "the" * 200, 50)], "lang string, word string, n long")
    learned = langid.fit(counted, ["en"], vocabulary)
    assert np.isfinite(learned).all() and learned.max() > 100 * learned.min()


def test_uses_are_added_up_over_tasks(spark, vocabulary):
    rng = np.random.default_rng(4)
    prob = rng.random((len(vocabulary.pieces), 2))
    prob /= prob.sum(0)
    words = ["".join(rng.choice(list("theandofüß"), rng.integers(1, 9))) for _ in range(300)]
    rows = [("de" if k % 3 else "en", w, k % 7 + 1) for k, w in enumerate(words)]
    counted = spark.createDataFrame(rows, "lang string, word string, n long").repartition(5)
    have = langid.uses(counted, ["de", "en"], vocabulary, prob)
    for k, lang in enumerate(("de", "en")):
        mine = [r for r in rows if r[0] == lang]
        want = langid.expected([r[1] for r in mine], np.array([[float(r[2])] for r in mine]), vocabulary, prob[:, [k]])
        assert np.allclose(have[:, k], want[:, 0])


def test_a_rare_word_decides(spark):
    """No number of other words keeps one out of the fit."""
    common = [f"{a}{b}{c}" for a in "bcdfghjk" for b in "aeiou" for c in "lmnprst"]
    rows = [(k, " ".join(common[k % 7 :: 7] * 3), lang) for k in range(60) for lang in ("xx" if k % 2 else "yy",)]
    rows += [(1001, "quixotry " + " ".join(common), "xx"), (1003, " ".join(common), "yy"), (5000, "quixotry", None)]
    found = {r.doc_id: r for r in langid.languages(cases.docs(spark, rows), PIECES).collect()}
    assert remainder and not found[1001].held_out and found[5000].lang_pred == "xx"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = langid.languages(docs, PIECES)
    both = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (both["lang_pred"] == both["lang"]).mean() > 0.97
    assert both["score"].between(0, 1).all()
    wrong = found.join(docs, "doc_id").filter(F.col("held_out") != (remainder(F.col("doc_id"), 4) == 2))
    assert wrong.count() == 0


def test_languages_of_odd_rows(spark):
    rows = cases.odd_rows() + [(70 + k, "the house is on the hill", "en") for k in range(20)] + [(90 + k, "das haus ist auf dem berg", "de") for k in range(20)]
    found = langid.languages(cases.docs(spark, rows), PIECES)
    assert found.count() == len(rows)
    by = {(r.doc_id, r.lang_pred, r.score) for r in found.collect() if r.doc_id in (1, 2, 3)}
    assert by == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    none = cases.docs(spark, [(1, "text", None), (2, None, None)])
    assert {(r.lang_pred, r.score) for r in langid.languages(none, PIECES).collect()} == {("und", 0.0)}
    assert langid.languages(cases.docs(spark, []), PIECES).count() == 0


def test_a_rare_language_is_learned(spark):
    rows = [(k, "the house is on the hill " * 3, "en") for k in range(200)]
    rows += [(1000 + k, "das haus ist auf dem berg " * 3, "de") for k in range(3)]
    found = langid.languages(cases.docs(spark, rows), PIECES, bound_docs=2)
    assert {r.doc_id for r in found.filter("lang_pred = 'de'").collect()} == {1000, 1001, 1002}


def plain_repetition(text):
    words = (text or "").encode().split()
    n = len(words)
    inside3, inside = set(), set()
    longest = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                longest[i] = max(longest[i], k)
    for i, k in enumerate(longest):
        if k >= 3:
            inside3 |= {i, i + 1, i + 2}
        if k >= 8:
            inside |= set(range(i, i + k))
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return n, sum(len(w.decode()) for w in words), len(lines) - len(set(lines)), len(inside3), len(inside), max(longest, default=0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "a", "b", "\n", "c|", "dd", "e\u2028f"]), max_size=90))
def test_repeats_against_all_pairs(words):
    text = " ".join(words)
    n, chars, symbols, dup, repeated, failed, kept, inside, most, _ = repetition.judge(text.encode(), 8, 0.25, 100)
    want = plain_repetition(text)
    assert (n, chars, dup, repeated, inside) == want[:5]
    assert most == (want[5] if want[5] >= 8 else 0)
    assert symbols == text.count("|")
    assert failed == (n < 50 or 100 * repeated > 50 * n)
    assert not (failed and kept)


def test_repetition_of_odd_rows(spark):
    clean, again = " ".join(cases.words(3, 120)), " ".join(cases.words(4, 60))
    rows = cases.odd_rows() + [(80, clean), (81, again + " " + again), (82, clean + "\n" + "x y z " * 200)]
    found = {r.doc_id: r for r in repetition.repetition_rules(cases.docs(spark, rows)).collect()}
    assert found[80].kept and found[5].kept
    assert not found[81].kept and found[81].longest_repeat == 60
    assert not found[82].kept
    assert found[1].n_words == 0 and found[1].base_failed
    assert repetition.repetition_rules(cases.docs(spark, [])).count() == 0


def plain_bigrams(rows, targets, size, strength):
    """The same two models with dictionaries."""
    from collections import Counter

    words = Counter(w for _, t in rows for w in (t or "").split())
    kept = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[:size]]
    code = {w: 1 + len(lm.SHAPES) + k for k, w in enumerate(kept)}
    ids = {i: [code.get(w, 1 + lm.shape(w)) for w in (t or "").split()] for i, (_, t) in enumerate(rows)}
    cells = 1 + len(lm.SHAPES) + len(kept)
    counts = [Counter(), Counter()]
    for i, (d, _) in enumerate(rows):
        for a, b in zip([0, *ids[i]], ids[i]):
            counts[1][a, b] += 1
            if d in targets:
                counts[0][a, b] += 1
    share = sum(counts[0].values()) / sum(counts[1].values())
    counts[1] = Counter({k: v * share for k, v in counts[1].items()})
    out = []
    for i, (d, _) in enumerate(rows):
        loss = [0.0, 0.0]
        for a, b in zip([0, *ids[i]], ids[i]):
            for k in (0, 1):
                single = sum(v for (_, y), v in counts[k].items() if y == b) + 1
                total = sum(counts[k].values()) + cells
                row = sum(v for (x, _), v in counts[k].items() if x == a)
                loss[k] -= math.log((counts[k][a, b] + strength * single / total) / (row + strength))
        n = max(1, len(ids[i]))
        out.append((d, len(ids[i]), loss[0] / n, loss[1] / n))
    return out


def test_scores_against_dictionaries(spark):
    rows = [(k, " ".join(cases.words(k % 7, 12 + k % 5)) + " END!! 12 x|y") for k in range(25)] + [(90, None), (91, "")]
    targets = {k for k in range(0, 25, 3)}
    target = spark.createDataFrame([(k,) for k in targets] + [(3,), (999,), (None,)], "doc_id long")
    found = lm.cross_entropy_difference(cases.docs(spark, rows), target, size=20, strength=5.0)
    have = sorted((r.doc_id, r.n_tokens, r.ce_target, r.ce_background) for r in found.collect())
    for h, w in zip(have, sorted(plain_bigrams(rows, targets, 20, 5.0))):
        assert h[:2] == w[:2]
        assert h[2] == pytest.approx(w[2], abs=1e-4) and h[3] == pytest.approx(w[3], abs=1e-4)


def test_scores_of_odd_rows(spark):
    table = cases.docs(spark, cases.odd_rows())
    none = spark.createDataFrame([], "doc_id long")
    assert {r.score for r in lm.cross_entropy_difference(table, none).collect()} == {0.0}
    assert lm.cross_entropy_difference(cases.docs(spark, []), none).count() == 0


def test_scores_with_all_words(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * 131 + j * j) % 2500}" for j in range(150))) for k in range(40)] + [(90, None), (None, "w1 w2"), (None, "w3")]
    targets = set(range(0, 40, 3))
    target = spark.createDataFrame([(k,) for k in targets], "doc_id long")
    want = sorted(plain_bigrams(rows, targets, 10**9, 50.0), key=repr)
    for size in (lm.CHUNK, 100):  # texts longer than a chunk are cut
        monkeypatch.setattr(lm, "CHUNK", size)
        found = lm.cross_entropy_difference(cases.docs(spark, rows), target)
        have = sorted(((r.doc_id, r.n_tokens, r.ce_target, r.ce_background) for r in found.collect()), key=repr)
        assert len({w for _, t in rows for w in (t or "").split()}) > 1500
        for h, w in zip(have, want, strict=True):
            assert h[:2] == w[:2]
            assert h[2] == pytest.approx(w[2], abs=1e-6) and h[3] == pytest.approx(w[3], abs=1e-6)


def test_questions_and_answers_are_short_and_exact():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 100_000, np.uint64, endpoint=False))
    order, ends, rests = lm.places(keys, 64)
    parts = [rests[a:b] for a, b in zip(ends, ends[1:])]
    packed = [lm.rising(r) for r in parts]
    assert sorted(order) == list(range(len(keys))) and len(set(zip(np.repeat(range(64), np.diff(ends)), rests))) == len(keys)
    assert all((lm.risen(p) == r).all() for p, r in zip(packed, parts))
    assert sum(len(zlib.compress(p, 1)) for p in packed) < 6.5 * len(keys)
    for most in (0, 1, 255, 256, 2**16, 2**33):
        values = np.append(rng.integers(0, 3, 10_000), most)
        assert (lm.wide(lm.narrow(values)) == values).all()
        assert len(zlib.compress(lm.narrow(values), 1)) < 5_000
    assert len(lm.wide(lm.narrow(values[:0]))) == len(lm.risen(lm.rising(keys[:0]))) == 0


def test_scoring_drops_its_shuffles(spark, monkeypatch):
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(name)
    monkeypatch.setattr(lm, "settle", lambda df, table: seen.append((table, spark.conf.get(name))) or settle(df, table))
    lm.cross_entropy_difference(cases.docs(spark, [(1, "a b")]), spark.createDataFrame([(1,)], "doc_id long"))
    assert seen == [("chunks", "true"), ("counts", "true")] and spark.conf.get(name) == before


def plain_marginals(score, switch):
    """P(good) of each line by listing all labellings."""
    n = len(score)
    weight = {}
    for mask in range(2**n):
        y = [(mask >> k) & 1 for k in range(n)]
        s = sum(score[k] for k in range(n) if y[k]) + sum(switch[y[k]][y[k + 1]] for k in range(n - 1))
        weight[tuple(y)] = math.exp(s)
    total = sum(weight.values())
    return [sum(w for y, w in weight.items() if y[k]) / total for k in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=7), st.lists(st.floats(-2, 2), min_size=4, max_size=4))
def test_marginals_against_all_labellings(score, flat):
    switch = np.array(flat).reshape(2, 2)
    want = plain_marginals(score, switch.tolist())
    pad = np.array([score + [0.0, 0.0]])
    mask = np.array([[True] * len(score) + [False, False]])
    good, pairs, _ = quality.marginals(pad, switch, mask)
    assert np.allclose(good[0, : len(score)], want)
    assert pairs.sum() == pytest.approx(len(score) - 1)
    features = np.zeros((len(score), quality.N_ALL))
    features[:, 0] = score
    weight = np.zeros(quality.N_ALL)
    weight[0] = 1
    sizes = np.arange(1.0, len(score) + 1)
    assert quality.mean_good(features, sizes, weight, switch) == pytest.approx((np.array(want) * sizes).sum() / sizes.sum())


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_scores(docs, labels)
    both = found.join(labels, "doc_id").filter("held_out").toPandas()
    assert (both["predicted"] == both["quality"]).mean() > 0.93
    assert found.filter((F.col("predicted") == 1) != (F.col("score") >= 0.3)).count() == 0
    assert found.filter(F.col("held_out") != (remainder(F.col("doc_id"), 5) == 0)).count() == 0


def test_quality_of_odd_rows(spark):
    rows = cases.odd_rows()
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 0), (9, 0, 0), (None, 1, 0), (7, None, None), (999, 0, 0)], "doc_id long, quality int, toxic int")
    table = cases.docs(spark, rows)
    found = quality.quality_scores(table, labels)
    assert found.count() == len(rows) and found.filter("score is null or score < 0 or score > 1").count() == 0
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns
    nothing = labels.limit(0)
    assert {r.score for r in quality.quality_scores(table, nothing).collect()} == {0.5}
    assert quality.quality_scores(cases.docs(spark, []), nothing).count() == 0


def test_quality_learns_from_lines_after_the_first_200(spark):
    def text(k, tail):
        return "\n".join([" ".join(cases.words(1000 * k + j, 8)) for j in range(200)] + [tail(1000 * k + j) for j in range(200, 600)])

    def plain(j):
        return " ".join(cases.words(j, 8))

    def junk(j):
        return f"### $$ || {j} !! <>"

    rows = [(k, text(k, junk if k % 2 else plain)) for k in range(40)]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(40)], "doc_id long, quality int")
    score = {r.doc_id: r.score for r in quality.quality_scores(cases.docs(spark, rows), labels).collect()}
    assert min(score[k] for k in range(0, 40, 2)) > 0.6 and max(score[k] for k in range(1, 40, 2)) < 0.4


def test_rows_of_one_id_are_kept_by_their_own_text(spark):
    def plain(k):
        return "\n".join(" ".join(cases.words(100 * k + j, 8)) for j in range(8))

    def junk(k):
        return "\n".join(f"### $$ || {k * j} !! <>" for j in range(8))

    rows = [(k, (junk if k % 2 else plain)(k)) for k in range(40)]
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(40)], "doc_id long, quality int")
    more = [(None, plain(50)), (None, junk(51)), (60, plain(60)), (60, junk(61)), (60, plain(60))]
    kept = quality.keep_good(cases.docs(spark, rows + more), labels).filter("doc_id is null or doc_id >= 40")
    assert cases.pairs(kept, "doc_id", "text") == sorted([more[0], more[2], more[4]], key=repr)
