"""Quality rules on repetition within one text, by a suffix array of its words.

The suffix array is built by prefix doubling; the ranks of every doubling give
the longest common prefix of neighbouring suffixes. A word starts a repeated
substring as long as its longer neighbour prefix; those that cannot be extended
to the left are the maximal repeats. Their spans are united; a text fails if
they cover too large a share of its words or if one is too long.

A null or empty text has no words and fails the base rule. Texts of any length
are treated whole. Rows are judged one by one, so repeated rows, ids and other
columns change nothing; an empty table gives an empty result.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.text import in_arrow, texts

SYMBOLS = b"#*$%&|<>"
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, covered_words long, longest_repeat long, n_maximal_repeats long"
)


def repeats(words: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring from there that occurs elsewhere."""
    n = len(words)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    levels = [words.astype(np.int64)]
    step = 1
    while True:
        rank = levels[-1]
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        step *= 2
        if new[order[-1]] == n - 1 or step >= n:
            break
        levels.append(new)
    first, second = order[:-1], order[1:]
    length = np.zeros(n - 1, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = np.append(levels[level], -1)
        a, b = np.minimum(first + length, n), np.minimum(second + length, n)
        # Ranks of level k agree if 2^k words do, or both texts end there, which two suffixes never do.
        same = (rank[a] == rank[b]) & (a < n) & (b < n)
        length += np.where(same, 1 << level, 0)
    longest[first] = length
    longest[second] = np.maximum(longest[second], length)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> int:
    """Positions of 0..n-1 in the union of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def judge(text: bytes, min_repeat: int, max_share: float, max_longest: int) -> tuple:
    words = text.split()
    n = len(words)
    letters = sum(map(len, words))
    white = len(text) - letters
    word_chars = len(text.decode("utf-8", "replace")) - white
    symbols = sum(text.count(bytes([c])) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    ids: dict[bytes, int] = {}
    coded = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    longest = repeats(coded)
    short = np.flatnonzero(longest >= 3)
    repeated = covered(short, np.full(len(short), 3), n) if len(short) else 0
    base_failed = n < 50 or 100 * repeated > 50 * n
    long = longest >= min_repeat
    long[1:] &= longest[:-1] < longest[1:] + 1
    at = np.flatnonzero(long)
    inside = covered(at, longest[at], n) if len(at) else 0
    most = int(longest[at].max()) if len(at) else 0
    kept = not base_failed and inside <= max_share * n and most <= max_longest
    return n, word_chars, symbols, dup_lines, repeated, base_failed, kept, inside, most, len(at)


def repetition_rules(docs: DataFrame, min_repeat: int = 8, max_share: float = 0.25, max_longest: int = 100) -> DataFrame:
    """One row per document with the base counts, both verdicts and what the repeats cover."""

    def rows(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, texts(batch)):
                yield (doc_id, *judge(text, min_repeat, max_share, max_longest))

    return in_arrow(docs.select(F.col("doc_id").cast("long"), "text"), rows, SCHEMA)
