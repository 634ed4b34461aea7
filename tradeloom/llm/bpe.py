"""Byte-level BPE by recursive DuckDB queries inside each task.

A piece (one match of the public pattern) becomes rows of word, position and
token. A recursive query joins neighbouring tokens with the merge table, takes
each word's pair of smallest rank (the leftmost of equal ones), contracts it, and
goes on until no word has a pair left. Decoding joins ids with the vocabulary and
concatenates their bytes in order.

A task's DuckDB holds a few thousand pieces at a time. A text is first cut before
every space that follows a non-space character, where no match of the pattern
crosses; parts and pieces seen before come from a memory of the Python worker. The
recursion takes one turn per merge over all rows of a word, so pieces of more than
LONG bytes, which no natural word has, are contracted by the same rule with a heap.

A null or empty text has no ids. Texts are encoded whole, special tokens' strings
as ordinary text. Repeated rows, null ids and other columns change nothing; an
empty table gives an empty result.
"""

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.ids import CUT, in_parts
from tradeloom.llm.text import in_arrow, kept_by_worker, whole

#: Parts and pieces that a worker remembers; a piece costs far more to make than a part, and comes back more often.
PARTS, KNOWN, LONG = 300_000, 1_000_000, 512
#: Without such a pair every space but a leading one follows a non-space character.
LOOSE = re.compile(r"\s ")
PIECES, TOKENS = 10_000, 200_000
#: Rows that a query's recursion makes at most, a row for each token and turn.
ROWS = 5_000_000
#: Characters of the texts whose new pieces are contracted together: every query costs its turns once.
TOGETHER = 8_000_000

CONTRACT = """
WITH RECURSIVE bpe(word, place, token, turn) AS (
    SELECT word, place, token, 0 FROM start
    UNION ALL
    SELECT old.word, (old.place - (old.place > best.place)::INT)::INT,
        CASE WHEN old.place = best.place THEN best.token ELSE old.token END, old.turn + 1
    FROM bpe old JOIN (
        SELECT word, min(choice) % 65536 AS place, (min(choice) // 65536)::INT AS token
        FROM (
            SELECT a.word, merges.token::BIGINT * 65536 + a.place AS choice
            FROM bpe a JOIN bpe b ON b.word = a.word AND b.place = a.place + 1
                JOIN merges ON merges.pair = (a.token::BIGINT << 32) + b.token)
        GROUP BY word) best ON best.word = old.word
    WHERE old.place <> best.place + 1)
SELECT word, list(token ORDER BY place) AS ids
FROM bpe JOIN (SELECT word, max(turn) AS turn FROM bpe GROUP BY word) USING (word, turn)
GROUP BY word ORDER BY word
"""

DECODE = """
SELECT part, unhex(string_agg(bytes, '' ORDER BY place)) AS data
FROM tokens JOIN vocabulary USING (token) GROUP BY part ORDER BY part
"""


def parts_of(text: str) -> list[str]:
    """The text cut before every space that follows a non-space character; a leading space may be cut off as well."""
    first, *rest = CUT.split(text) if LOOSE.search(text) else text.split(" ")
    return [first, *[" " + p for p in rest]]


def batches_of(pieces: list[bytes]) -> Iterator[list[bytes]]:
    """Pieces for one query each, of like lengths: a query takes as many turns as its longest piece needs."""
    held, rows = [], 0
    for piece in sorted(pieces, key=len):
        made = len(piece) * (len(piece) + 1) // 2
        if held and (len(held) == PIECES or rows + made > ROWS):
            yield held
            held, rows = [], 0
        held.append(piece)
        rows += made
    if held:
        yield held


class Coder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ranks = self.ranks
        self.pattern = regex.compile(pattern)
        self.parts: dict[str, bytes] = {}
        self.pieces: dict[bytes, bytes] = {}
        self.byte = np.array([ranks[bytes([k])] for k in range(256)], np.int32)
        pairs = [
            ((ranks[k[:i]] << 32) + ranks[k[i:]], rank)
            for k, rank in ranks.items() for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks
        ]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})
        merges = pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "token": pa.array([t for _, t in pairs], pa.int32())})
        vocabulary = pa.table({"token": pa.array(ranks.values(), pa.int32()), "bytes": [k.hex() for k in ranks]})
        for name, table in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _query(self, name: str, table: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, table)
        found = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return found

    def contract(self, pieces: list[bytes]) -> None:
        """Put the ids of new pieces into memory."""
        todo = []
        for piece in pieces:
            if piece in self.ranks:
                self.pieces[piece] = self.ranks[piece].to_bytes(4, "little")
            elif len(piece) > LONG:
                self.pieces[piece] = np.array(heap_merge(piece, self.ranks), "<u4").tobytes()
            else:
                todo.append(piece)
        for part in batches_of(todo):
            sizes = np.array([len(p) for p in part])
            ends = np.cumsum(sizes)
            start = pa.table({
                "word": np.repeat(np.arange(len(part), dtype=np.int32), sizes),
                "place": (np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)).astype(np.int32),
                "token": self.byte[np.frombuffer(b"".join(part), np.uint8)],
            })
            lists = self._query("start", start, CONTRACT).column("ids").combine_chunks()
            flat, cuts = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy()
            for piece, a, b in zip(part, cuts[:-1], cuts[1:]):
                self.pieces[piece] = flat[a:b].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.parts) > PARTS:
            self.parts.clear()
        if len(self.pieces) > KNOWN:
            self.pieces.clear()
        cut = [parts_of(text) for text in texts]
        new = list(set().union(*cut).difference(self.parts))
        split = [[m.encode() for m in self.pattern.findall(p)] for p in new]
        self.contract(list({m for matches in split for m in matches if m not in self.pieces}))
        for part, matches in zip(new, split):
            self.parts[part] = b"".join([self.pieces[m] for m in matches])
        return [b"".join(map(self.parts.__getitem__, parts)) for parts in cut]

    def decode(self, encoded: list[bytes]) -> list[list[bytes]]:
        """Each text's bytes, in stretches, from its ids alone."""
        out: list[list[bytes]] = [[] for _ in encoded]
        owners, held, total = [], [], 0
        for k, ids in enumerate(encoded):
            for at in range(0, len(ids), 4 * TOKENS):
                owners.append(k)
                held.append(ids[at : at + 4 * TOKENS])
                total += len(held[-1]) // 4
                if total >= TOKENS:
                    self._decode(owners, held, out)
                    owners, held, total = [], [], 0
        if held:
            self._decode(owners, held, out)
        return out

    def _decode(self, owners: list[int], held: list[bytes], out: list[list[bytes]]) -> None:
        sizes = np.array([len(h) // 4 for h in held])
        ids = np.frombuffer(b"".join(held), "<u4").astype(np.int32)
        tokens = pa.table({
            "part": np.repeat(np.arange(len(held), dtype=np.int32), sizes), "place": np.arange(len(ids), dtype=np.int32), "token": ids,
        })
        found = self._query("tokens", tokens, DECODE)
        for part, data in zip(found.column("part").to_pylist(), found.column("data").to_pylist()):
            out[owners[part]].append(data)


def heap_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction of one piece, with the next pair taken from a heap."""
    size = len(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    end = list(range(1, size + 1))
    alive = [True] * size
    heap = [(ranks[piece[k : k + 2]], k, k + 2) for k in range(size - 1) if piece[k : k + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, k, stop = heapq.heappop(heap)
        if not alive[k] or after[k] >= size or end[after[k]] != stop:
            continue
        gone = after[k]
        alive[gone], end[k], after[k] = False, stop, after[gone]
        if after[k] < size:
            before[after[k]] = k
        for left in (before[k], k):
            if left >= 0 and after[left] < size:
                to = end[after[left]]
                if (rank := ranks.get(piece[left:to])) is not None:
                    heapq.heappush(heap, (rank, left, to))
    return [ranks[piece[k : end[k]]] for k in range(size) if alive[k]]


def coder(path: str, pattern: str) -> Coder:
    return kept_by_worker(f"bpe:{path}:{pattern}", lambda: Coder(path, pattern))


def encode(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and ids of every row of ``docs``."""

    def rows(batches):
        tool = coder(vocabulary, pattern)
        for batch in batches:
            for names, bodies in in_parts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), TOGETHER):
                for name, ids in zip(names, tool.encode(bodies)):
                    yield name, np.frombuffer(ids, "<u4").astype(np.int32)

    return in_arrow(whole(docs), rows, "doc_id long, ids array<int>", flush=500)


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of every row of ``encoded`` (doc_id, ids)."""

    def rows(batches):
        tool = coder(vocabulary, pattern)
        for batch in batches:
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column(1).to_pylist()]
            for name, stretches in zip(batch.column(0).to_pylist(), tool.decode(ids)):
                yield name, b"".join(stretches)

    return in_arrow(encoded.select(F.col("doc_id").cast("long"), "ids"), rows, "doc_id long, data binary", flush=500)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: encoded and decoded in one pass."""

    def rows(batches):
        tool = coder(vocabulary, pattern)
        for batch in batches:
            for names, bodies in in_parts(batch.column(0).to_pylist(), batch.column(1).to_pylist(), TOGETHER):
                encoded = tool.encode(bodies)
                for name, ids, stretches in zip(names, encoded, tool.decode(encoded)):
                    back = hashlib.sha256()
                    for s in stretches:
                        back.update(s)
                    yield name, len(ids) // 4, hashlib.sha256(ids).hexdigest(), back.hexdigest()

    return in_arrow(whole(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
