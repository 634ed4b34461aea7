"""BPE, token files and packing against the public libraries."""

import base64
import hashlib
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradeloom.llm import bpe, packing, tokenfile
from tradeloom.llm.ids import Encoder

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    tool = Tokenizer.from_file(JSON)
    tool.encode_special_tokens = True
    return lambda text: tool.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return bpe.Coder(MULTI, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def cached():
    return Encoder(JSON)


ODD = [
    "", " ", "  a  b\n\n c ", "don't we'll I'M", "x" * 700, "ab" * 600 + "!", "\x1c\x85\u3000 x", "日本語のテキスト", "a\u2028 b", "<|endoftext|>",
    "٣٤ ½ x²", "\U0001f600" * 200, "\t\t\tif x:\r\n", " \u00a0 nbsp", "=" * 900, "e\u0301" * 40,
]


@settings(max_examples=150, deadline=None)
@given(text=st.one_of(st.text(max_size=80), st.text(alphabet="ab ' st\n\u3000é", max_size=120)))
def test_same_ids_as_the_libraries(plain, library, own, cached, text):
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == plain.encode_ordinary(text)
    assert np.frombuffer(cached.encode([text])[0], "<u4").tolist() == library(text)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(plain, library, own, cached, text):
    ids = own.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
    assert b"".join(own.decode([ids])[0]) == text.encode()
    assert np.frombuffer(cached.encode([text])[0], "<u4").tolist() == library(text)


def test_every_character_has_the_librarys_ids(cached):
    """The table of ranks gives what the tokenizers library gives, around every character there is."""
    assert cached.fast
    for at in range(0, 0x110000, 0x8000):
        some = [chr(c) for c in range(at, at + 0x8000) if not 0xD800 <= c < 0xE000]
        texts = [f"a{c}b {c}{c}1{c} 2{c}. {c}\n{c} x  {c}'s{c}" for c in some]
        want = cached.library.encode_batch_fast(texts, add_special_tokens=False)
        assert cached.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in want]


@settings(max_examples=200, deadline=None)
@given(text=st.text(alphabet=st.characters(codec="utf-8")) | st.text(alphabet="ab '\n\t.,1stré\u3000", max_size=80))
def test_any_text_has_the_librarys_ids(cached, library, text):
    assert np.frombuffer(cached.encode([text])[0], "<u4").tolist() == library(text)


def test_the_library_is_loaded_only_when_it_is_asked():
    alone = Encoder(JSON)
    assert alone.encode(["Some text"])[0] and "library" not in vars(alone)


def test_other_files_go_to_the_library():
    other = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Some text,  twice", "", "日本"]
    assert other.fast is None
    assert other.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in other.library.encode_batch(texts, add_special_tokens=False)]


def test_rows_of_one_id_are_spread_over_tasks(spark, tmp_path):
    rows = [(None if k % 3 == 0 else k, f"text {k} and more") for k in range(3000)]
    tokenfile.write_ids(cases.docs(spark, rows), str(tmp_path / "ids"), JSON)
    sizes = [len(tokenfile.read_image(bytes(r.image))[0]) for r in spark.read.parquet(str(tmp_path / "ids")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


def test_parts_join_to_the_text_and_end_before_spaces():
    for text in ("", " ", "  a", "a b", "a  b", " a b ", "a\n b c", "a\u3000 b", "one two three", "x \t y"):
        parts = bpe.parts_of(text)
        assert "".join(parts) == text
        assert all(p[0] == " " and not q[-1:].isspace() for q, p in zip(parts, parts[1:]))


def test_pieces_of_like_lengths_share_a_query():
    pieces = [bytes([k % 251]) * n for k in range(251) for n in (2, 5, 40, 500)] + [b"%d" % k for k in range(10_000)]
    batches = list(bpe.batches_of(pieces))
    assert sorted(p for b in batches for p in b) == sorted(pieces) and list(bpe.batches_of([])) == []
    assert all(len(b) <= bpe.PIECES and sum(len(p) * (len(p) + 1) // 2 for p in b) <= bpe.ROWS for b in batches)
    # queries with long pieces, which take hundreds of turns, are few
    assert max(map(len, batches[0])) <= 5 and sum(max(map(len, b)) == 500 for b in batches) <= 8


def test_pieces_stay_known_after_parts_are_forgotten():
    tool = bpe.Coder(MULTI, public_tokenizers.PATTERN)
    text = "Anansha ouémenque; nachtigallenhaft"
    want = tool.encode([text])
    known = dict(tool.pieces)
    tool.pieces.update((b"%d!" % k, b"") for k in range(400_000))
    tool.parts.update((f"{k}!", b"") for k in range(400_000))
    made = []
    tool._query = lambda *given: made.append(given)
    assert tool.encode([text]) == want and not made
    assert len(tool.parts) < 10 and all(tool.pieces[p] == ids for p, ids in known.items())


def test_bpe_of_odd_rows(spark, plain):
    rows = cases.odd_rows()
    found = bpe.round_trip(cases.docs(spark, rows), MULTI, public_tokenizers.PATTERN)
    want = []
    for doc_id, text in rows:
        ids = np.array(plain.encode_ordinary(text or ""), "<u4")
        want.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert cases.pairs(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_encode_then_decode_as_tables(spark):
    rows = [(1, "some text, twice"), (2, None), (3, "ß日")]
    ids = bpe.encode(cases.docs(spark, rows), MULTI, public_tokenizers.PATTERN)
    back = bpe.decode(ids, MULTI, public_tokenizers.PATTERN)
    assert cases.pairs(back.select("doc_id", F.decode("data", "UTF-8").alias("t")), "doc_id", "t") == [(1, "some text, twice"), (2, ""), (3, "ß日")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    given_ids = np.array(ids, np.uint64)
    words, offsets = tokenfile.pack(given_ids)
    assert tokenfile.unpack(words, offsets, len(ids)).tolist() == ids
    assert len(offsets) == -(-len(ids) // tokenfile.BLOCK)
    assert len(words) <= 2 * len(ids)


def test_simple8b_packs_small_ids_densely():
    words, _ = tokenfile.pack(np.ones(256, np.uint64))
    assert len(words) <= 6
    words, _ = tokenfile.pack(np.full(256, 40_000, np.uint64))
    assert len(words) == 86  # three of twenty bits


def test_cut_off_segment_is_refused():
    data = tokenfile.image([1, None], [2, 1], np.array([5, 6, 7], np.uint64))
    assert tokenfile.read_image(data)[0] == [1, None]
    with pytest.raises(ValueError):
        tokenfile.read_image(data[:-8])
    with pytest.raises(ValueError):
        tokenfile.read_image(b"\0" * 40)


@pytest.mark.parametrize("segment", [50, 1_000_000])
def test_token_file_of_odd_rows(spark, library, segment):
    rows = [r for r in cases.odd_rows() if r != (11, "texts") and r != (4, "one")] + [(4, "one")]
    found = tokenfile.round_trip(cases.docs(spark, rows), JSON, segment=segment).orderBy(F.asc_nulls_first("doc_id"), "start").collect()
    left = {}
    for doc_id, text in rows:
        ids = np.array([*library(text or ""), 0], "<u4")
        left.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    start = 0
    for r in found:
        assert r.start == start
        left[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert not any(left.values())


def check_packing(found, want, limits):
    """want: doc_id -> list of id arrays; every id lies in one piece, sequences hold to the limits."""
    at = {}
    for r in found:
        at.setdefault(r.sequence_id, []).append(r)
    for pieces in at.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()
        assert sum(p.length for p in pieces) <= limits.tokens
        assert len(pieces) <= limits.segments
        assert sum(p.loss_tokens for p in pieces) <= limits.loss
    by_doc = {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, ids in want.items():
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r.start)
        place = 0
        for p in pieces:
            assert p.start == place and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[place : place + p.length].tobytes())
            place += p.length
        assert place == len(ids)
    assert not by_doc


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40), packing.Limits(100, 100, 7)])
def test_packing_keeps_every_id_once(spark, library, limits):
    rows = [r for i, r in enumerate(cases.odd_rows()) if r[0] is not None and r[0] not in (4, 11)]
    rows += [(100 + k, " ".join(cases.words(k, 3 + 5 * (k % 9)))) for k in range(60)]
    found = packing.pack_documents(cases.docs(spark, rows), JSON, limits=limits, pool=16, counts=F.col("doc_id") % 2 == 0).collect()
    check_packing(found, {d: np.array([*library(t or ""), 1], "<u4") for d, t in rows}, limits)


def test_packing_leaves_little_padding(spark):
    rows = [(k, " ".join(cases.words(k, 5 + k % 300))) for k in range(600)]
    found = packing.pack_documents(cases.docs(spark, rows).coalesce(1), JSON)
    sizes = [r.n for r in found.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding <= 0.001 * sum(sizes)


def test_limits_must_be_positive():
    with pytest.raises(ValueError):
        packing.Limits(0)


def test_empty_tables(spark):
    none = cases.docs(spark, [])
    assert bpe.round_trip(none, MULTI, public_tokenizers.PATTERN).count() == 0
    assert tokenfile.round_trip(none, JSON).count() == 0
    assert packing.pack_documents(none, JSON).count() == 0
