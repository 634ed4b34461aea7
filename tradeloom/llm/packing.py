"""Vector bin packing of documents into training sequences.

A sequence has three limits at once: tokens, segments and tokens that count for
the loss. Pieces are placed by the dot-product heuristic: of the pieces that fit
the open sequence, the one whose demand vector has the largest dot product with
the room left goes in. Where none fits and documents may be cut, the piece with
the largest product is cut to the room and its rest goes back to the pool.

Each task packs the documents that it reads, in pools of ``pool`` pieces, so
nothing is shuffled and no group grows with the data; pieces left over from one
pool go into the next. The tokens left when a task ends are fewer than one
sequence holds. They are laid into sequences of lengths that are powers of two
(which need no padding), largest first.

A null or empty text is one piece with the end id. Repeated rows are documents of
their own. Null ids stay null. An empty table gives no pieces.
"""

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.ids import encoder, in_parts
from tradeloom.llm.text import in_arrow

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


@dataclass
class Piece:
    """Part of a document: its ids, which of them count for the loss, and where it begins."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    loss: np.ndarray
    whole: int

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        head = Piece(self.doc_id, self.start, self.ids[:at], self.loss[:at], self.whole)
        return head, Piece(self.doc_id, self.start + at, self.ids[at:], self.loss[at:], self.whole)


def loss_room(piece: Piece, tokens: int, loss: int) -> int:
    """How many of the first ``tokens`` ids can be taken with at most ``loss`` that count."""
    counted = np.cumsum(piece.loss[:tokens])
    return int(np.searchsorted(counted, loss, "right"))


def fill(pool: list[Piece], limits: Limits):
    """Yield full sequences (lists of pieces); what is left stays in ``pool``.

    A sequence is complete when no tokens or segments are left, or when even a cut
    piece brings nothing because the loss limit is reached.
    """
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    need = np.zeros((2 * len(pool) + 8, 3))
    items: list[Piece | None] = list(pool)
    for k, piece in enumerate(items):
        need[k] = len(piece.ids), 1, piece.loss.sum()
    live = np.zeros(len(need), bool)
    live[: len(items)] = True
    waiting = int(need[: len(items), 0].sum())
    count = len(items)
    while count and waiting >= limits.tokens:
        room, sequence = cap.copy(), []
        while count and room[0] >= 1 and room[1] >= 1:
            worth = (need[: len(items)] / cap) @ (room / cap)
            open_ = live[: len(items)]
            fits = open_ & (need[: len(items)] <= room).all(1)
            if fits.any():
                k = int(np.argmax(np.where(fits, worth, -1)))
                sequence.append(items[k])
                room -= need[k]
                live[k], items[k] = False, None
                count -= 1
                continue
            k = int(np.argmax(np.where(open_, worth, -1)))
            take = loss_room(items[k], int(room[0]), int(room[2]))
            if not take:
                break
            head, rest = items[k].cut(take)
            sequence.append(head)
            room -= len(head.ids), 1, head.loss.sum()
            items[k] = rest
            need[k] = len(rest.ids), 1, rest.loss.sum()
        waiting -= sum(len(p.ids) for p in sequence)
        yield sequence
    pool[:] = [p for p in items if p is not None]


def remainder(pool: list[Piece], limits: Limits):
    """The rest of a task: sequences of lengths that are powers of two, largest first."""
    while pool:
        left = sum(len(p.ids) for p in pool)
        room, segments, loss, sequence = 1 << (min(left, limits.tokens).bit_length() - 1), limits.segments, limits.loss, []
        pool.sort(key=lambda p: -len(p.ids))
        while pool and room and segments:
            take = loss_room(pool[0], min(room, len(pool[0].ids)), loss)
            if not take:
                break
            head, rest = pool[0].cut(take)
            sequence.append(head)
            room, segments, loss = room - take, segments - 1, loss - int(head.loss.sum())
            pool[:1] = [rest] if len(rest.ids) else []
        yield sequence


def pack(pieces, limits: Limits = Limits(), pool: int = 1024):
    """Sequences of pieces from an iterator of pieces, with at most ``pool`` held at a time."""
    held: list[Piece] = []
    for piece in pieces:
        while len(piece.ids) >= limits.tokens:  # whole sequences from a long document
            take = loss_room(piece, limits.tokens, limits.loss)
            head, piece = piece.cut(take)
            yield [head]
        if len(piece.ids):
            held.append(piece)
        if len(held) >= pool:
            yield from fill(held, limits)
    yield from fill(held, limits)
    yield from remainder(held, limits)


def rows_of(sequences, part: int):
    """Rows of SCHEMA; a sequence's id holds the partition and a running number."""
    for number, sequence in enumerate(sequences):
        offset = 0
        for p in sequence:
            crc = zlib.crc32(p.ids.tobytes())
            yield p.doc_id, p.start, len(p.ids), crc, p.whole, (part << 36) + number, offset, int(p.loss.sum())
            offset += len(p.ids)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int = 1, limits: Limits = Limits(), pool: int = 1024, counts: Column | None = None
) -> DataFrame:
    """Pieces of all documents with their sequence.

    ``counts`` tells whether a row's ids count for the loss (all do by default);
    for instruction data, say, ``F.col("role") == "assistant"``.
    """
    flag = F.lit(True) if counts is None else F.coalesce(counts, F.lit(False))

    def rows(batches):
        tool = encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()

        def pieces():
            for batch in batches:
                names = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
                for some, bodies in in_parts(names, batch.column(1).to_pylist()):
                    for (name, counted), found in zip(some, tool.encode(bodies)):
                        ids = np.frombuffer(found + end, "<u4")
                        yield Piece(name, 0, ids, np.full(len(ids), counted, np.int32), len(ids))

        yield from rows_of(pack(pieces(), limits, pool), TaskContext.get().partitionId())

    text = F.coalesce("text", F.lit("")).alias("text")
    return in_arrow(docs.select(F.col("doc_id").cast("long"), text, flag.alias("counts")), rows, SCHEMA)
