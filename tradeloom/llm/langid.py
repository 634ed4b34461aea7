"""Language by unigram models over a fixed vocabulary, summed over all segmentations.

A word's probability in a language is the sum, over every way to cut it into
pieces of the vocabulary, of the product of the pieces' probabilities; a forward
pass over its characters gives it. Piece probabilities come from expectation
maximisation over word counts. All words of a part of a task are taken side by
side: one step of the pass handles one end position of all of them.

The fit uses at most ``bound_docs`` labelled documents per language, chosen by a hash
of their id, and all their words; all documents up to that number, so every language
with a labelled document outside the held-out fold is learned. A round of the fit maps
over the counted words and adds up the expected uses of each piece; only those sums
(pieces x languages) come to the driver. Rows without id or language are not learned
from. A text that is null, empty or without a letter is ``und`` with score 0, and so is
every text if there is nothing to learn from. The score is the posterior of the predicted
language under equal priors; of equal languages the first in order wins. Words
are lower-cased and cut at white space. Rows are judged one by one; an empty table
gives an empty result.
"""

from collections import Counter

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle
from tradeloom.llm.ids import in_parts
from tradeloom.llm.text import in_arrow, kept_by_worker, remainder

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPREAD = np.uint64(0xD6E8FEB86659FD93)
BITS = 20
#: Characters of the longest piece of the vocabulary.
LONGEST = 16
FLOOR = 1e-7
#: Characters (words x longest word) that one step of work may hold.
CELLS = 400_000


def code_points(words: list[str], width: int) -> np.ndarray:
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    return flat.reshape(len(words), width).astype(np.uint64)


class Vocabulary:
    """All pieces, found by a 64-bit hash of their characters."""

    def __init__(self, path: str):
        self.path = path
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = {model.id_to_piece(k) for k in range(model.get_piece_size()) if not model.is_control(k) and not model.is_byte(k)}
        self.pieces = sorted(p for p in names if p)
        if max(map(len, self.pieces)) > LONGEST:
            raise ValueError(f"a piece has more than {LONGEST} characters")
        self.powers = np.array([pow(int(BASE), k, 2**64) for k in range(LONGEST + 1)], np.uint64)
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        self.tables = []
        todo = np.arange(len(self.pieces))
        for turn in range(64):
            if not len(todo):
                break
            spread = SPREAD + np.uint64(2 * turn)
            slots = (hashes[todo] * spread) >> np.uint64(64 - BITS)
            _, first = np.unique(slots, return_index=True)
            key, value = np.zeros(1 << BITS, np.uint64), np.full(1 << BITS, -1, np.int32)
            key[slots[first]], value[slots[first]] = hashes[todo[first]], todo[first]
            self.tables.append((spread, key, value))
            todo = np.delete(todo, first)

    def _hash(self, piece: str) -> int:
        value = 0
        for c in piece:
            value = (value * int(BASE) + ord(c) + 1) % 2**64
        return value

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces, -1 for none."""
        out = np.full(len(hashes), -1, np.int32)
        for spread, key, value in self.tables:
            slot = (hashes * spread) >> np.uint64(64 - BITS)
            hit = (key[slot] == hashes) & (value[slot] >= 0)
            out[hit] = value[slot[hit]]
        return out


def chunks(words: list[str]):
    """Places of words of similar length, few enough to handle at once."""
    order = np.argsort([len(w) for w in words], kind="stable")
    begin = 0
    while begin < len(order):
        end = min(len(order), begin + max(1, CELLS // (len(words[order[begin]]) + 1)))
        while end - begin > 1 and (end - begin) * (len(words[order[end - 1]]) + 1) > 2 * CELLS:
            end = begin + (end - begin) // 2
        yield order[begin:end]
        begin = end


def of_worker(path: str) -> Vocabulary:
    """This worker's vocabulary: its tables are made where they are used and never sent."""
    return kept_by_worker(f"pieces:{path}", lambda: Vocabulary(path))


def prefix_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix hashes of the words, each with the mark of a word's begin, by position; lengths."""
    marked = ["▁" + w for w in words]
    lengths = np.array([len(w) for w in marked])
    points = code_points(marked, int(lengths.max()))
    hashes = np.zeros((points.shape[1] + 1, len(words)), np.uint64)
    for e in range(points.shape[1]):
        hashes[e + 1] = hashes[e] * BASE + points[:, e] + np.uint64(1)
    return hashes, lengths


def word_scores(words: list[str], vocabulary: Vocabulary, prob: np.ndarray) -> np.ndarray:
    """Log probabilities (words x languages), summed over all segmentations."""
    out = np.zeros((len(words), prob.shape[1]))
    padded = np.vstack([prob, np.zeros(prob.shape[1])])  # number -1 is no piece
    for part in chunks(words):
        hashes, lengths = prefix_hashes([words[k] for k in part])
        n, scale = len(part), np.zeros((len(part), prob.shape[1]))
        recent = [np.ones((n, prob.shape[1]))]  # forward values of the last LONGEST ends
        result = np.zeros_like(scale)
        for e in range(1, len(hashes)):
            value = np.zeros_like(scale)
            for size in range(1, min(LONGEST, e) + 1):
                piece = vocabulary.find(hashes[e] - hashes[e - size] * vocabulary.powers[size])
                if size == 1:
                    value += recent[-1] * np.maximum(padded[piece], FLOOR)
                else:
                    hit = np.flatnonzero(piece >= 0)
                    value[hit] += recent[-size][hit] * prob[piece[hit]]
            recent = [*recent[-LONGEST + 1 :], value]
            if e % 16 == 0:
                most = np.maximum.reduce(recent)
                recent = [r / most for r in recent]
                scale += np.log(most)
            done = lengths == e
            if done.any():
                result[done] = scale[done] + np.log(recent[-1][done])
        out[part] = result
    return out


def expected(words: list[str], counts: np.ndarray, vocabulary: Vocabulary, prob: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece by language, over all segmentations."""
    total = np.zeros_like(prob)
    for part in chunks(words):
        hashes, lengths = prefix_hashes([words[k] for k in part])
        ends, n, langs = len(hashes), len(part), prob.shape[1]
        # Logarithms of the forward sums; a piece's share in the sum at its end is at most 1 at every length.
        forward, found = np.zeros((ends, n, langs)), {}
        for e in range(1, ends):
            value = np.zeros((n, langs))
            for size in range(1, min(LONGEST, e) + 1):
                piece = vocabulary.find(hashes[e] - hashes[e - size] * vocabulary.powers[size])
                hit = np.flatnonzero(piece >= 0)
                found[e, size] = hit, piece[hit]
                weight = prob[piece[hit]]
                if size == 1:
                    value[:] = FLOOR
                    value[hit] = np.maximum(weight, FLOOR)
                else:
                    value[hit] += weight * np.exp(forward[e - size, hit] - forward[e - 1, hit])
            forward[e] = forward[e - 1] + np.log(value)
        inside = np.zeros((ends, n, langs))  # how probable it is that a piece ends here
        inside[lengths, np.arange(n)] = 1
        for e in range(ends - 1, 0, -1):
            for size in range(1, min(LONGEST, e) + 1):
                hit, piece = found[e, size]
                weight = prob[piece]
                if size == 1:
                    every = np.full((n, langs), FLOOR)
                    every[hit] = weight = np.maximum(weight, FLOOR)
                    inside[e - 1] += every * np.exp(forward[e - 1] - forward[e]) * inside[e]
                share = weight * np.exp(forward[e - size, hit] - forward[e, hit]) * inside[e, hit]
                if size > 1:
                    inside[e - size, hit] += share
                use = share * counts[part[hit]]
                for k in range(langs):
                    np.add.at(total[:, k], piece, use[:, k])
    return total


def uses(counted: DataFrame, langs: list[str], vocabulary: Vocabulary, prob: np.ndarray) -> np.ndarray:
    """``expected`` over the counted words (lang, word, n) of every language."""
    path, number = vocabulary.path, {lang: k for k, lang in enumerate(langs)}

    def rows(batches):
        own = of_worker(path)
        total = np.zeros_like(prob)
        for batch in batches:
            at = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
            for k in np.unique(at).tolist():
                mine = np.flatnonzero(at == k)
                total[:, k] += expected([words[m] for m in mine], n[mine, None], own, prob[:, [k]])[:, 0]
        for piece, k in zip(*np.nonzero(total)):
            yield int(piece), int(k), float(total[piece, k])

    found = in_arrow(counted, rows, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
    out = np.zeros_like(prob)
    out[found["piece"], found["lang"]] = found["uses"]
    return out


def fit(counted: DataFrame, langs: list[str], vocabulary: Vocabulary, rounds: int = 3) -> np.ndarray:
    """Piece probabilities by language (pieces x languages)."""
    prob = np.full((len(vocabulary.pieces), len(langs)), 1 / len(vocabulary.pieces))
    for _ in range(rounds):
        got = uses(counted, langs, vocabulary, prob) + 0.05
        prob = got / got.sum(0)
    return prob


def learn(docs: DataFrame, vocabulary: Vocabulary, bound_docs: int = 4000):
    """Languages in order and piece probabilities, or None without a labelled row."""
    doc_id = F.col("doc_id").cast("long")
    known = docs.select(doc_id.alias("doc_id"), "lang").filter(
        doc_id.isNotNull() & F.col("lang").isNotNull() & (remainder(doc_id, 4) != 2)
    )
    known = settle(known.distinct(), "labelled")
    # Ids are thinned evenly first, so that no task gets all of a large language.
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("__n"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) * F.col("__n") < 4e6 * bound_docs + 1e8
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    thinned = known.join(F.broadcast(counts), "lang").filter(part)
    sample = thinned.withColumn("__place", place).filter(F.col("__place") <= bound_docs).select("doc_id", "lang")
    chosen = docs.select(doc_id.alias("doc_id"), "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"]).select("lang", "text")

    def rows(batches):
        seen: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update((lang, w) for w in (text or "").lower().split())
        for (lang, word), n in seen.items():
            yield lang, word, n

    counted = in_arrow(chosen, rows, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Small rows, much work each: as many parts as the session shuffles into.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = settle(counted.repartition(parts, "word"), "words")
    langs = sorted(r.lang for r in counted.select("lang").distinct().collect())
    return (langs, fit(counted, langs, vocabulary)) if langs else None


def languages(docs: DataFrame, vocabulary_path: str, bound_docs: int = 4000) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of ``docs``."""
    vocabulary = Vocabulary(vocabulary_path)
    model = learn(docs, vocabulary, bound_docs)
    doc_id = F.col("doc_id").cast("long")
    picked = docs.select(doc_id.alias("doc_id"), remainder(doc_id, 4).alias("fold"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = model and model[1].astype(np.float32)

    def rows(batches):
        own = of_worker(vocabulary_path)
        place: dict[str, int] = {}
        scores = np.zeros((0, len(model[0]) if model else 0), np.float32)
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for some, bodies in in_parts(names, batch.column(2).to_pylist()):
                if not model:
                    yield from ((name, fold == 2, "und", 0.0) for name, fold in some)
                    continue
                split = [t.lower().split() for t in bodies]
                if len(place) > 500_000:
                    place, scores = {}, scores[:0]
                new = list({w for words in split for w in words if w not in place})
                if new:
                    place.update(zip(new, range(len(place), len(place) + len(new))))
                    scores = np.vstack([scores, word_scores(new, own, pieces).astype(np.float32)])
                for (name, fold), text, words in zip(some, bodies, split):
                    if not any(map(str.isalpha, text)):
                        yield name, fold == 2, "und", 0.0
                        continue
                    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    sums = scores[at].sum(0, dtype=float)
                    best = int(sums.argmax())
                    yield name, fold == 2, model[0][best], float(1 / np.exp(sums - sums[best]).sum())

    return in_arrow(picked, rows, "doc_id long, held_out boolean, lang_pred string, score double")
