"""Licence scans against plain searches and a recursive parser, and their results on odd rows."""

import re

import cases
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import licenses, queries

FOLDER = "/root/testdata/sf0.01"
TOOL = licenses.automaton()


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_places(words, phrases):
    return [
        (label, k) for phrase, label in phrases.items() for k in range(len(words))
        if words[k : k + len(phrase.split())] == phrase.split()
    ]


def plain_base(text):
    words = plain_words(text)
    base = plain_places(words, licenses.BASE)
    starts = [k for _, k in base]
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for b, _ in base}))


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op13_license_scan"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    labelled = 0
    for doc in docs:
        row, words = found[doc.doc_id], plain_words(doc.text)
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_base(doc.text)
        # no document of this table has a tag, so the labels are those of the phrases
        assert row.labels == ",".join(sorted({b for b, _ in plain_places(words, licenses.BASE | licenses.NOTICES)}))
        free = [licenses.FREEDOM[b] for b in row.labels.split(",") if b]
        assert row.score == min(free, default=0.0)
        labelled += bool(free)
    assert labelled > 5


FRAGMENTS = ["GNU General Public License", "gnu", "Apache-License", "CC BY", "cc by nc sa", "MIT\nLicense", "license", "é", "mit", " ", "İ", ".", "cc", "by"]


@settings(max_examples=150, deadline=None)
@given(parts=st.lists(st.sampled_from(FRAGMENTS), max_size=14), gap=st.sampled_from([" ", "", "\n", "_"]))
def test_places_against_plain_search(parts, gap):
    text = gap.join(parts)
    have = licenses.judge(TOOL, text.encode())
    assert have[:5] == plain_base(text)
    want = sorted(plain_places(plain_words(text), licenses.BASE | licenses.NOTICES))
    assert sorted((label, first) for label, first, _ in have[7]) == want


def plain_value(tokens):
    """Recursive descent: (labels, freedom) of a whole expression."""
    tokens = list(tokens)

    def name():
        token = tokens.pop(0)
        if token == "(":
            value = either()
            assert tokens.pop(0) == ")"
            return value
        label = licenses.family(token)
        return {label}, licenses.FREEDOM[label]

    def joined(word, part, value_of):
        left = part()
        while tokens and tokens[0] == word:
            tokens.pop(0)
            left = value_of(left, part())
        return left

    def exception():
        return joined("with", name, lambda a, b: (a[0] | {f"{x}-exception" for x in a[0]}, (a[1] + 1) / 2))

    def both():
        return joined("and", exception, lambda a, b: (a[0] | b[0], min(a[1], b[1])))

    def either():
        return joined("or", both, lambda a, b: (a[0] | b[0], max(a[1], b[1])))

    return either()


NAMES = st.sampled_from(["mit", "apache-2.0", "gpl-2.0-only", "lgpl-2.1+", "epl-2.0", "bsd-3-clause", "weird-1"]).map(lambda n: [n])
EXPRESSIONS = st.recursive(
    NAMES,
    lambda e: st.one_of(
        st.tuples(e, st.sampled_from(["and", "or"]), e).map(lambda t: [*t[0], t[1], *t[2]]),
        e.map(lambda t: ["(", *t, ")"]),
        e.map(lambda t: ["(", *t, ")", "with", "classpath-exception-2.0"]),
    ),
    max_leaves=9,
)


@settings(max_examples=200, deadline=None)
@given(tokens=EXPRESSIONS, tail=st.sampled_from(["", "\nmore text", " */", " , and so on"]))
def test_expressions_against_recursive_parser(tokens, tail):
    text = "x\n// SPDX-License-Identifier: " + " ".join(tokens).replace("( ", "(").replace(" )", ")").upper() + tail
    row = licenses.judge(TOOL, text.encode())
    labels, free = plain_value(tokens)
    assert set(row[5].split(",")) == labels and row[6] == pytest.approx(free)


@pytest.mark.parametrize(
    ("line", "labels", "free"),
    [
        ("MIT.", "mit", 0.9), ("(MIT OR GPL-3.0-only", "gpl,mit", 0.9), ("MIT AND", "mit", 0.9), ("MIT and the rest of it", "mit,other", 0.1),
        ("MIT )", "mit", 0.9), ("OR MIT", "", 0.0), ("", "", 0.0), ("()", "", 0.0), ("MIT AND (", "mit", 0.9), ("((MIT)) OR (", "mit", 0.9),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", "gpl,gpl-exception,mit", 0.65), ("Unknown-1.0", "other", 0.1),
    ],
)
def test_broken_expressions(line, labels, free):
    row = licenses.judge(TOOL, f"SPDX-License-Identifier: {line}".encode())
    assert (row[5], row[6]) == (labels, pytest.approx(free))


def test_base_labels_stay():
    row = licenses.judge(TOOL, b"Under the MIT License.\nSPDX-License-Identifier: Apache-2.0\nlicense-expression = ISC\nThe SPDX license identifier of it.")
    assert row[4:7] == ("mit", "apache,isc,mit", 0.85)


def test_odd_rows(spark):
    rows = cases.odd_rows() + [(50, "mit license " * 40_000), (51, "SPDX-License-Identifier: " + "(" * 5000 + "mit" + ")" * 5000), (52, "apache license mit license")]
    found = licenses.scan(cases.docs(spark, rows))
    have = cases.pairs(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert have == sorted([(d, *plain_base(t)) for d, t in rows], key=repr)
    assert found.filter("doc_id = 51").first().labels == "mit"
    assert licenses.scan(cases.docs(spark, [])).count() == 0
