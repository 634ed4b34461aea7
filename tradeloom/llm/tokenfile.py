"""Token-id files in Simple-8b words.

A segment is the image of a file: a header, the documents' lengths, the offset
of each block's first word, then 64-bit words. A block holds 256 ids (the last
one fewer). The top four bits of a word select how many ids of what width it
packs, ids from the low bits up; selector 0 is an escape: the next word is one
id of up to 64 bits as it is. A block starts at a word of its own, so all blocks
are coded and decoded side by side.

Segments are rows of a Parquet table, so that Spark writes and reads them in any
store, commits them at once and repeats lost tasks. They follow ascending
doc_id: partitions are ranges, and segments are numbered in each.

A null text is empty: the document has its end id only. Null ids come first.
Repeated rows are documents of their own, in no fixed order among themselves.
An empty table gives no segments and no rows.
"""

import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import scratch_path
from tradeloom.llm.ids import encoder, in_parts
from tradeloom.llm.text import in_arrow, whole

MAGIC = 0x3842_5349
BLOCK = 256
#: Ids in a word and bits of each, by selector; selector 0 is the escape.
COUNTS = (1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: Ids of one segment, unless a single document has more.
SEGMENT = 1_000_000


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of ids (unsigned 64-bit) and the place of each block's first word."""
    n = len(ids)
    starts = np.arange(0, n, BLOCK)
    ends = np.minimum(starts + BLOCK, n)
    place = np.arange(n)
    room = np.minimum(BLOCK - place % BLOCK, n - place)
    # For every place the selector of the fullest word that could begin there.
    choice = np.zeros(n, np.int8)
    largest, reach = ids.copy(), 1
    for selector in range(len(COUNTS) - 1, 0, -1):
        count, width = COUNTS[selector], WIDTHS[selector]
        while reach < count:
            step = min(reach, count - reach)
            if step < n:
                np.maximum(largest[: n - step], largest[step:].copy(), out=largest[: n - step])
            reach += step
        fits = (largest < np.uint64(1) << np.uint64(width)) & (room >= count)
        if not fits.any():
            break
        choice[fits] = selector
    counts = np.array(COUNTS)
    at, block = starts.copy(), np.arange(len(starts))
    heads, owners, orders = [], [], []
    turn = 0
    while len(at):
        heads.append(at)
        owners.append(block)
        orders.append(np.full(len(at), turn))
        at = at + counts[choice[at]]
        live = at < ends[block]
        at, block = at[live], block[live]
        turn += 1
    head = np.sort(np.concatenate(heads)) if heads else np.zeros(0, int)
    chosen = choice[head].astype(np.int64)
    size = 1 + (chosen == 0)
    first = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for selector in np.unique(chosen).tolist():
        mine = chosen == selector
        at, to = head[mine], first[mine]
        if selector == 0:
            words[to + 1] = ids[at]
            continue
        word = np.full(len(at), selector << 60, np.uint64)
        for k in range(COUNTS[selector]):
            word |= ids[at + k] << np.uint64(k * WIDTHS[selector])
        words[to] = word
    return words, first[np.searchsorted(head, starts)]


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids of ``pack``'s words; every block is followed from its offset."""
    ids = np.zeros(n, np.uint64)
    at, block = offsets.astype(np.int64), np.arange(len(offsets))
    to = block * BLOCK
    ends = np.minimum(to + BLOCK, n)
    while len(at):
        word = words[at]
        selectors = (word >> np.uint64(60)).astype(np.int64)
        step, moved = np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
        for selector in np.unique(selectors).tolist():
            mine = selectors == selector
            moved[mine] = COUNTS[selector]
            if selector == 0:
                ids[to[mine]] = words[at[mine] + 1]
                step[mine] = 2
                continue
            low = (np.uint64(1) << np.uint64(WIDTHS[selector])) - np.uint64(1)
            for k in range(COUNTS[selector]):
                ids[to[mine] + k] = (word[mine] >> np.uint64(k * WIDTHS[selector])) & low
        at, to = at + step, to + moved
        live = to < ends[block]
        at, to, block = at[live], to[live], block[live]
    return ids


def image(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    known = np.array([d is not None for d in doc_ids], "<u8")
    names = np.array([d or 0 for d in doc_ids], "<i8")
    header = np.array([MAGIC, len(doc_ids), len(ids), len(offsets), len(words)], "<u8")
    parts = (header, known, names, np.array(lengths, "<u8"), offsets.astype("<u8"), words.astype("<u8"))
    return b"".join(p.tobytes() for p in parts)


def read_image(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """The ids of the documents, their lengths, and all token ids one after the other."""
    magic, n_docs, n_ids, n_blocks, n_words = np.frombuffer(data, "<u8", 5).tolist()
    if magic != MAGIC:
        raise ValueError("not a token-id segment")
    rest = np.frombuffer(data, "<u8", offset=40)
    known, names, lengths, offsets, words = np.split(rest, np.cumsum([n_docs, n_docs, n_docs, n_blocks]))
    if len(words) != n_words:
        raise ValueError("a token-id segment was cut off")
    doc_ids = [n if k else None for k, n in zip(known.tolist(), names.astype(np.int64).tolist())]
    return doc_ids, lengths.astype(np.int64), unpack(words, offsets, n_ids)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, segment: int = SEGMENT) -> None:
    """Write the segments of all documents to ``path``."""

    def rows(batches):
        tool, part, number = encoder(vocabulary), TaskContext.get().partitionId(), 0
        names, lengths, held, total, ahead = [], [], [], 0, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for some, bodies in in_parts(batch.column(0).to_pylist(), texts):
                for name, found in zip(some, tool.encode(bodies)):
                    names.append(name)
                    lengths.append(len(found) // 4 + 1)
                    held.append(found + end)
                    total += lengths[-1]
                    if total >= segment:
                        yield part, number, ahead, total, _image(names, lengths, held)
                        ahead, number = ahead + total, number + 1
                        names, lengths, held, total = [], [], [], 0
        if names:
            yield part, number, ahead, total, _image(names, lengths, held)

    # Rows of one id (a third may have none) are spread over tasks by a hash of their texts.
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = whole(docs).repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = "part int, number int, ahead long, n_ids long, image binary"
    in_arrow(ordered, rows, schema, flush=1).write.option("compression", "none").parquet(path)


def _image(names: list, lengths: list[int], held: list[bytes]) -> bytes:
    return image(names, lengths, np.frombuffer(b"".join(held), "<u4").astype(np.uint64))


def read_ids(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the written segments."""
    segments = spark.read.parquet(path)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # one row per written partition
    bases, before = [], 0
    for row in sorted(sizes):
        bases.append((row.part, before))
        before += row.n
    base = F.broadcast(spark.createDataFrame(bases, "part int, base long"))
    placed = segments.join(base, "part").select((F.col("base") + F.col("ahead")).alias("start"), "image")

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                start = batch.column(0)[k].as_py()
                names, lengths, ids = read_image(batch.column(1)[k].as_py())
                small = ids.astype("<u4")
                ends = np.cumsum(lengths)
                for name, size, end in zip(names, lengths.tolist(), ends.tolist()):
                    yield name, start + end - size, size, zlib.crc32(small[end - size : end].tobytes())

    return in_arrow(placed, rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str, path: str | None = None, end_id: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write the segments and read every document back from them."""
    path = path or scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, vocabulary, end_id, segment)
    return read_ids(docs.sparkSession, path)
