"""Cross-entropy difference of a target and a background bigram model.

Both models share one vocabulary: all words of all documents. (A caller may give
``size``: then the most frequent words, and a class for every shape of the others.)
Both count bigrams of their whole corpus (the target's documents, and all
documents); the background's counts are scaled to the target's total, so the models
are matched in mass and smoothing: a bigram is smoothed by ``strength``
pseudo-counts spread as the unigrams. A document's score is the mean over its
tokens of target loss minus background loss; lower means closer to the target.

No table of counts is gathered anywhere. Documents are written once as chunks of at
most CHUNK tokens. A chunk asks for each of its different words and bigrams once,
with its own counts of them; questions are dealt into buckets by hash, a bucket adds
up and answers every chunk with the sums over all chunks. So a frequent bigram
comes once a chunk, however many documents have it, and the number of buckets
follows the number of tokens. Words and bigrams are told apart by 64 bits of hash:
among n different ones about n * n / 2**65 pairs share their counts by accident (3e-6
for ten million, 3 for ten thousand million).

A null or empty text has no tokens and score 0. Without a target row both models
agree and all scores are 0. Repeated rows count as often as they occur. An empty
table gives an empty result.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle, shuffles_dropped
from tradeloom.llm.ids import in_parts
from tradeloom.llm.text import in_arrow

#: Shapes of words that the vocabulary lacks, tried in order; the last fits all.
SHAPES = [re.compile(p) for p in (
    r"[a-z]{1,4}$", r"[a-z]{5,9}$", r"[a-z]+$", r"[a-z]+[.,;:]$", r"[A-Z][a-z]+[.,;:]?$", r"[A-Z]+[.,;:]?$", r"[A-Z.,]+!+$",
    r"\d+[.,;:]?$", r"[^\W\d_]+[.,;:]?$", r".*[#*$%&]", r".*[<>{}|=]", r".*[/@]", r".*\d", r"\W+$", r"",
)]
#: Tokens of a chunk, and of those that share a bucket on average.
CHUNK, BUCKET = 1_000_000, 2_000_000


def shape(word: str) -> int:
    return next(k for k, p in enumerate(SHAPES) if p.match(word))


def number(word: str) -> int:
    """64 bits for a word; 0 begins a text, and the next ones are the shapes."""
    value = xxhash.xxh3_64_intdigest(word.encode())
    return value if value > len(SHAPES) else value + 1 + len(SHAPES)


class Coder:
    """Numbers of words; without a vocabulary all words are known."""

    def __init__(self, vocabulary: list[str] | None):
        self.fixed = {w: number(w) for w in vocabulary or []}
        self.other = number if vocabulary is None else lambda w: 1 + shape(w)
        self.known = dict(self.fixed)

    def encode(self, text: str) -> np.ndarray:
        words, known = text.split(), self.known
        if len(known) > 500_000:
            known = self.known = dict(self.fixed)
        for w in words:
            if w not in known:
                known[w] = self.other(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def frequent_words(docs: DataFrame, size: int) -> list[str]:
    def rows(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((text or "").split())
                if len(seen) > 300_000:
                    yield from seen.items()
                    seen.clear()
        yield from seen.items()

    counts = in_arrow(docs.select("text"), rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, after a byte that tells how many.

    The first bytes of all numbers come first, then all second ones: high bytes are mostly
    zeros, which compress to nothing when they lie together.
    """
    kind = np.min_scalar_type(int(values.max(initial=0)))
    size = kind.itemsize
    return bytes([size]) + values.astype(kind.newbyteorder("<")).view(np.uint8).reshape(-1, size).T.tobytes()


def _joined(data: bytes) -> np.ndarray:
    size = data[0]
    return np.frombuffer(data, np.uint8, offset=1).reshape(size, -1).T.copy().view(f"<u{size}").ravel()


def wide(data: bytes) -> np.ndarray:
    return _joined(data).astype(np.int64)


def rising(keys: np.ndarray) -> bytes:
    """Rising keys as the steps between them, which are shorter than the keys."""
    return narrow(np.diff(keys, prepend=np.uint64(0)))


def risen(data: bytes) -> np.ndarray:
    return np.cumsum(_joined(data), dtype=np.uint64)


def chunks(docs: DataFrame, vocabulary: list[str] | None) -> DataFrame:
    """Documents (doc_id, text, target) as word numbers, at most CHUNK tokens to a row.

    A longer text is cut into pieces; ``lead`` has the word before each piece.
    """

    def rows(batches):
        coder, part, made, row, size, held = Coder(vocabulary), TaskContext.get().partitionId(), 0, 0, 0, []

        def packed():
            names, ids, flags, leads, tokens = zip(*held)
            words, at = np.unique(np.concatenate([np.array(leads, np.uint64), *tokens]), return_inverse=True)
            lengths = np.array([len(t) for t in tokens])
            n_target = int(lengths[np.array(flags)].sum())
            return (
                (part << 32) + made, int(lengths.sum()), n_target, list(names), list(ids), words.tobytes(),
                narrow(at[: len(held)]), narrow(at[len(held) :]), narrow(lengths), narrow(np.array(flags, int)),
            )

        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            for some, bodies in in_parts(names, batch.column(1).to_pylist()):
                for (doc_id, target), text in zip(some, bodies):
                    found, at = coder.encode(text), 0
                    while True:
                        piece = found[at : at + CHUNK - size]
                        held.append(((part << 40) + row, doc_id, target, int(found[at - 1]) if at else 0, piece))
                        at, size = at + len(piece), size + len(piece)
                        if size >= CHUNK or len(held) >= CHUNK:
                            yield packed()
                            made, size, held = made + 1, 0, []
                        if at >= len(found):
                            break
                    row += 1
        if held:
            yield packed()

    schema = (
        "chunk long, n_tokens long, n_target long, names array<long>, ids array<long>, words binary, "
        "lead binary, at binary, lengths binary, flags binary"
    )
    return in_arrow(docs.select("doc_id", "text", "target"), rows, schema, flush=1)


BODY = ["words", "lead", "at", "lengths", "flags"]


class Chunk:
    """Word places before and at each token of a chunk, its piece, and the different bigrams."""

    def __init__(self, words: bytes, lead: bytes, at: bytes, lengths: bytes, flags: bytes):
        self.words, self.second, self.lengths = np.frombuffer(words, "<u8"), wide(at), wide(lengths)
        self.piece = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.first = np.concatenate(([0], self.second))[:-1] if len(self.second) else self.second
        full = self.lengths > 0
        self.first[(np.cumsum(self.lengths) - self.lengths)[full]] = wide(lead)[full]
        self.target = wide(flags)[self.piece] > 0
        n = np.uint64(len(self.words))
        pair, self.pair = np.unique(self.first.astype(np.uint64) * n + self.second.astype(np.uint64), return_inverse=True)
        a, b = (pair // max(n, np.uint64(1))).astype(int), (pair % max(n, np.uint64(1))).astype(int)
        self.pairs = _mix(_mix(self.words[a]) * np.uint64(0x9E3779B97F4A7C15) + self.words[b])

    def counts(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of the words as second and as first, and of the bigrams: target and background counts."""
        t, n, m = self.target, len(self.words), len(self.pairs)
        single = [np.bincount(x, minlength=n) for x in (self.second[t], self.second, self.first[t], self.first)]
        return single, [np.bincount(x, minlength=m) for x in (self.pair[t], self.pair)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of keys by bucket, where each bucket begins and ends in it, and the ordered keys' rests.

    A key is known by its bucket and its rest; rests rise inside a bucket.
    """
    mixed = _mix(keys)
    order = np.argsort(mixed)
    bucket = (mixed[order] % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
    order, sizes = order[np.argsort(bucket, kind="stable")], np.bincount(bucket, minlength=buckets)
    return order, np.concatenate(([0], np.cumsum(sizes))), mixed[order] // np.uint64(buckets)


def questions(written: DataFrame, buckets: int) -> DataFrame:
    """A row for every chunk and bucket: the different words, or bigrams, and the chunk's counts of them."""

    def rows(batches):
        for batch in batches:
            for chunk, *body in zip(*[c.to_pylist() for c in batch.columns]):
                own = Chunk(*body)
                for pairs, keys, counts in zip((False, True), (own.words, own.pairs), own.counts()):
                    order, ends, rests = places(keys, buckets)
                    for k in np.flatnonzero(np.diff(ends)).tolist():
                        some = order[ends[k] : ends[k + 1]]
                        yield k, chunk, pairs, rising(rests[ends[k] : ends[k + 1]]), [narrow(c[some]) for c in counts]

    return in_arrow(written.select("chunk", *BODY), rows, "bucket int, chunk long, pairs boolean, keys binary, counts array<binary>", flush=500)


def answers(key, frame: pd.DataFrame) -> pd.DataFrame:
    """The sums over all chunks, for each question of a bucket in its own order."""
    out = []
    for pairs, some in frame.groupby("pairs"):
        asked = [risen(k) for k in some["keys"]]
        different, at = np.unique(np.concatenate(asked), return_inverse=True)
        sums = []
        for k in range(2 if pairs else 4):
            total = np.zeros(len(different), np.int64)
            np.add.at(total, at, np.concatenate([wide(c[k]) for c in some["counts"]]))
            sums.append(total)
        n_words = 0 if pairs else int(np.count_nonzero(sums[1]))
        ends = np.cumsum([len(a) for a in asked])
        for k, chunk in enumerate(some["chunk"]):
            own = at[ends[k] - len(asked[k]) : ends[k]]
            out.append((key[0], chunk, pairs, n_words, [narrow(s[own]) for s in sums]))
            n_words = 0
    return pd.DataFrame(out, columns=["bucket", "chunk", "pairs", "n_words", "counts"])


def cross_entropy_difference(docs: DataFrame, target: DataFrame, size: int | None = None, strength: float = 50.0) -> DataFrame:
    """doc_id, n_tokens, ce_target, ce_background and score for every row of ``docs``.

    ``target`` has the doc_id of each document of the target corpus.
    """
    vocabulary = None if size is None else frequent_words(docs, size)
    # One plan at every size: labels grow with the documents, so they are never broadcast.
    wanted = target.select(F.col("doc_id").cast("long").alias("__wanted")).distinct().hint("merge")
    marked = docs.select(F.col("doc_id").cast("long").alias("__doc"), "text").join(
        wanted, F.col("__doc") == F.col("__wanted"), "left"
    )
    marked = marked.select(
        F.col("__doc").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("__wanted").isNotNull().alias("target")
    )
    spark = docs.sparkSession
    with shuffles_dropped(spark):
        written = settle(chunks(marked, vocabulary), "chunks")
    total = written.agg(F.sum("n_tokens").alias("n"), F.sum("n_target").alias("t")).first()
    n_all, n_target = total.n or 0, total.t or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_all // BUCKET))
    schema = "bucket int, chunk long, pairs boolean, n_words long, counts array<binary>"
    with shuffles_dropped(spark):
        answered = settle(questions(written, buckets).groupBy("bucket").applyInPandas(answers, schema), "counts")
    n_words = len(vocabulary) if vocabulary is not None else answered.agg(F.sum("n_words")).first()[0] or 0
    cells, share = 1 + len(SHAPES) + n_words, n_target / max(1, n_all)

    def score(key, frame: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        body = frame.iloc[0]
        own = Chunk(*[body[c] for c in BODY])
        single, pair = [np.zeros(len(own.words)) for _ in range(4)], [np.zeros(len(own.pairs)) for _ in range(2)]
        for pairs, keys, into in ((False, own.words, single), (True, own.pairs, pair)):
            order, ends, _ = places(keys, buckets)
            for bucket, counts in replies.loc[replies["pairs"] == pairs, ["bucket", "counts"]].itertuples(index=False):
                for k, c in enumerate(counts):
                    into[k][order[ends[bucket] : ends[bucket + 1]]] = wide(c)
        sums = []
        for k in (0, 1):
            # Without a target both models are the background.
            from_, scale = (k, share if k else 1) if n_target else (1, 1)
            spread, before, both = single[from_] * scale, single[2 + from_] * scale, pair[from_] * scale
            unigram = (spread + 1) / ((n_target or n_all) + cells)
            p = (both[own.pair] + strength * unigram[own.second]) / (before[own.first] + strength)
            sums.append(np.bincount(own.piece, -np.log(p), minlength=len(own.lengths)))
        ids = pd.array([None if d is None or d != d else int(d) for d in body["ids"]], "Int64")
        return pd.DataFrame({"name": body["names"], "doc_id": ids, "n": own.lengths, "a": sums[0], "b": sums[1]})

    scored = written.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInPandas(score, "name long, doc_id long, n long, a double, b double")
    whole = scored.groupBy("name", "doc_id").agg(*[F.sum(c).alias(c) for c in "nab"])
    a, b = (F.col(c) / F.greatest("n", F.lit(1)) for c in "ab")
    return whole.select("doc_id", F.col("n").alias("n_tokens"), a.alias("ce_target"), b.alias("ce_background"), (a - b).alias("score"))
